import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stateline.session import scratch_path
from stateline.sources import readers, sinks, splitting
from stateline.sources.manifest import CITIES, POPULATION, RAW, TABLES, schema

LINES = schema(a="long", b="text", c="double", d="date")


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_manifest():
    assert len(RAW) == 8
    assert {raw.kind for raw in RAW.values()} <= set(readers.READERS)
    assert list(TABLES) == [
        "staging_demographic", "staging_education", "staging_temperature", "staging_covid", "state",
        "education", "covid",
    ]


def test_csv_by_name(spark, tmp_path, rows):
    path = put(tmp_path / "x.csv", 'other,c,b,a,d\nq,1.5,"x, ""y""",1,2020-01-02\n,,NA,2,\n')
    assert rows(readers.read_csv(spark, path, LINES)) == [
        (1, 'x, "y"', 1.5, dt.date(2020, 1, 2)), (2, None, None, None)
    ]


def test_csv_missing_column(spark, tmp_path):
    with pytest.raises(ValueError, match="no column c, d"):
        readers.read_csv(spark, put(tmp_path / "x.csv", "a,b\n1,x\n"), LINES)


def test_csv_bad_value(spark, tmp_path, rows):
    path = put(tmp_path / "x.csv", "a,b,c,d\none,x,1.0,2020-01-01\n2,y,z,2020-01-01\n3,w,3,\n")
    with pytest.raises(PySparkException):
        readers.read_csv(spark, path, LINES).collect()
    found = readers.read_csv(spark, path, LINES, lenient=True)
    assert rows(found, "b", "a", "c", readers.BAD_COLUMNS) == [
        ("w", 3, 3.0, []), ("x", None, 1.0, ["a"]), ("y", 2, None, ["c"])
    ]


RAGGED = "a,b,c,d\n1,x,1.0,2020-01-01\n2,y,EXTRA,1.5,2020-01-01\n3,z\n4,w,2.0,2020-01-01,,LAST\n"


def test_csv_long_lines(spark, tmp_path, rows):
    """A line with more cells than the header is refused or counted, a shorter one is padded."""
    path = put(tmp_path / "x.csv", RAGGED)
    with pytest.raises(PySparkException, match="more than 4 cells: 2,y,EXTRA"):
        readers.read_csv(spark, path, LINES).count()
    found = readers.read_csv(spark, path, LINES, lenient=True)
    assert rows(found, "a", readers.BAD_COLUMNS) == [
        (1, []), (2, ["c", "d", "_surplus"]), (3, []), (4, ["_surplus"])
    ]
    short = put(tmp_path / "short.csv", "a,b,c,d\n3,z\n")
    assert rows(readers.read_csv(spark, short, LINES)) == [(3, "z", None, None)]


@pytest.mark.parametrize("blanks", [0, 3, 70, 1000])
@pytest.mark.parametrize("surplus, lost", [("LOST", True), ('"LOST, too"', True), ('" "', True), ("", False), ('""', False)])
def test_surplus_cells_are_all_looked_at(spark, tmp_path, rows, blanks, surplus, lost):
    path = put(tmp_path / "x.csv", f'a,b,c,d\n1,"x,y",1,2020-01-01\n2,"y ""q"", z",,{"," * blanks},{surplus}\n')
    found = readers.read_csv(spark, path, LINES, lenient=True)
    assert rows(found, "a", "b", readers.BAD_COLUMNS) == [(1, "x,y", []), (2, 'y "q", z', ["_surplus"] if lost else [])]
    for read in (readers.read_csv, readers.stage_csv):
        if lost:
            with pytest.raises(PySparkException, match="more than 4 cells"):
                read(spark, path, LINES).collect()
        else:
            assert rows(read(spark, path, LINES), "a") == [(1,), (2,)]


def test_staged_long_lines(spark, tmp_path, rows):
    with pytest.raises(PySparkException, match="more than 4 cells"):
        readers.stage_csv(spark, put(tmp_path / "x.csv", RAGGED), LINES).select("a").collect()
    quoted = 'a;b;c;d\n1;"x;y";2.0;\n2\n'
    assert rows(readers.stage_csv(spark, put(tmp_path / "y.csv", quoted), LINES, sep=";")) == [
        (1, "x;y", 2.0, None), (2, None, None, None)
    ]


def test_options_of_the_manifest_readers(spark, tmp_path, rows):
    """The cities as one object per line, which Spark splits; a school with a quoted line break."""
    fields = [{"state": "Ohio", "race": "White", "count": 3}, {"state": "Utah", "race": "Asian", "count": 4}]
    put(tmp_path / RAW["cities"].path, "\n".join(json.dumps({"fields": f}) for f in fields))
    assert rows(readers.read_raw(spark, str(tmp_path), "cities", lines=True), "state") == [("Ohio",), ("Utah",)]
    put(tmp_path / RAW["public_schools"].path, 'NAME,CITY,STATE,COUNTY,COUNTRY,ENROLLMENT,FT_TEACHER\n"a\nb",c,OH,d,e,1,2\n')
    assert rows(readers.read_raw(spark, str(tmp_path), "public_schools", multi_line=True), "NAME") == [("a\nb",)]


def test_csv_files_with_another_header_are_refused(spark, tmp_path):
    put(tmp_path / "in" / "1.csv", "a,b,c,d\n1,x,1,2020-01-01\n")
    put(tmp_path / "in" / "2.csv", "b,a,c,d\nx,1,1,2020-01-01\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.read_csv(spark, str(tmp_path / "in"), LINES).collect()


def test_csv_quoted_line_break(spark, tmp_path, rows):
    path = put(tmp_path / "x.csv", 'a,b,c,d\n1,"x\ny",1,\n')
    assert rows(readers.read_csv(spark, path, LINES, multi_line=True)) == [(1, "x\ny", 1.0, None)]


@pytest.fixture
def small_parts(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "200b")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_in_a_file_that_is_split(spark, tmp_path, rows, small_parts, end):
    """Records over line ends, over parts and over many parts; quotes in quotes; separators in cells; blank lines."""
    def cell(i):
        kinds = ["x", "a\nb", 'say ""hi""', ",,", "\n\n", "long " * 150 + "\n" + "text\n" * 90, '""\n""', " ", ""]
        return f'"{kinds[i % len(kinds)]}{i}"' if i % 10 else f"plain {i}"

    lines = [f"{i},{cell(i)},{i}.5,2020-01-{1 + i % 28:02}" for i in range(200)]
    lines[50:50] = ["", ""]
    text = end.join(["a,b,c,d", *lines]) + end
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_bytes(text.encode())
    (tmp_path / "in" / "2.csv").write_bytes(f'a,b,c,d{end}900,"only{end}one",1,2020-01-01'.encode())
    path = str(tmp_path / "in")
    found = readers.read_csv(spark, path, LINES, quoted_breaks=True)
    assert splitting._text_lines(spark, path).rdd.getNumPartitions() > 20
    got, whole = rows(found), rows(readers.read_csv(spark, path, LINES, multi_line=True))
    assert len(got) == 201
    if end == "\n":
        assert got == whole
    else:  # Spark's reader makes quoted ends of two characters one; here cells stay as they are
        assert [(r[0], r[1] and r[1].replace("\r\n", "\n")) for r in got] == [(r[0], r[1]) for r in whole]
    assert rows(readers.read_csv(spark, path, LINES, quoted_breaks=True, lenient=True), "a", readers.BAD_COLUMNS) == [(r[0], []) for r in got]


def test_lines_inside_cells_are_not_looked_at_as_records(spark, tmp_path, rows, small_parts):
    """Lines of a text with more separators than columns, in parts without a quote; a filter on a cell that they cannot be."""
    text = "\n".join(f"p, q, r, s, t, line {i}" for i in range(60))
    plain = "".join(f"{i},plain,1.5,2020-01-01\n" for i in range(10, 40))
    path = put(tmp_path / "x.csv", f'a,b,c,d\n1,"{text}",1.5,2020-01-01\n{plain}2,"{text}\n",,\n')
    found = readers.read_csv(spark, path, LINES, quoted_breaks=True)
    expected = [(1, text), *[(i, "plain") for i in range(10, 40)], (2, f"{text}\n")]
    assert rows(found, "a", "b") == sorted(expected)
    assert rows(found.where("a between 2 and 10"), "a", "b") == [(2, f"{text}\n"), (10, "plain")]
    lenient = readers.read_csv(spark, path, LINES, quoted_breaks=True, lenient=True)
    assert rows(lenient.where(F.size(readers.BAD_COLUMNS) > 0)) == []


def test_quoted_breaks_of_odd_files(spark, tmp_path, rows):
    put(tmp_path / "long" / "x.csv", 'a,b,c,d\n1,"x\ny",1,2020-01-01,"more\nlost"\n')
    with pytest.raises(PySparkException, match="more than 4 cells"):
        readers.read_csv(spark, str(tmp_path / "long"), LINES, quoted_breaks=True).collect()
    put(tmp_path / "open" / "x.csv", 'a,b,c,d\n1,"x\ny,1,2020-01-01\n')
    with pytest.raises(PySparkException, match="a quote is not closed"):
        readers.read_csv(spark, str(tmp_path / "open"), LINES, quoted_breaks=True).collect()
    put(tmp_path / "bare" / "x.csv", "a,b,c,d\n")
    assert rows(readers.read_csv(spark, str(tmp_path / "bare"), LINES, quoted_breaks=True)) == []


def test_stage_csv(spark, tmp_path, rows):
    long_name = "n" * 300
    path = put(
        tmp_path / "x.csv",
        f'h1,h2,h3,h4\n1,"x, y",2.5,2020-01-01\n2,short\n3,  ,  ,\n4,{long_name},1,2020-01-02\n',
    )
    found = rows(readers.stage_csv(spark, path, LINES))
    assert found == [
        (1, "x, y", 2.5, dt.date(2020, 1, 1)), (2, "short", None, None), (3, None, None, None),
        (4, long_name, 1.0, dt.date(2020, 1, 2)),
    ]
    cut = rows(readers.stage_csv(spark, path, LINES, cut_text=256))
    assert len(cut[3][1]) == 256 and cut[0][1] == "x, y"


def test_stage_csv_bad_number(spark, tmp_path):
    path = put(tmp_path / "x.csv", "a,b,c,d\nx,y,1,\n")
    with pytest.raises(PySparkException):
        readers.stage_csv(spark, path, LINES).collect()


def test_stage_json_by_key(spark, tmp_path, rows):
    path = put(tmp_path / "x.json", '{"c": 1.5, "a": 1, "z": 0}\n{"b": "q", "d": "2020-01-01"}\n')
    assert rows(readers.stage_json(spark, path, LINES)) == [
        (1, None, 1.5, None), (None, "q", None, dt.date(2020, 1, 1))
    ]


@pytest.mark.parametrize("lines", [False, True])
def test_enveloped_json(spark, tmp_path, rows, lines):
    objects = [
        {"datasetid": "d", "fields": {"state": "Ohio", "race": "Asian", "count": 3, "city": "X"}},
        {"datasetid": "d", "fields": {"state": "Utah", "count": 4}},
    ]
    text = "\n".join(map(json.dumps, objects)) if lines else json.dumps(objects, indent=1)
    found = readers.read_enveloped_json(spark, put(tmp_path / "x.json", text), CITIES, lines=lines)
    assert rows(found) == [("Ohio", "Asian", 3), ("Utah", None, 4)]


def test_json_matrix_in_any_column_order(spark, tmp_path, rows):
    first = [["POP_2021", "NAME", "state"], ["5", "Ohio", "39"], ["7", "Utah", "49"]]
    second = [[r[2], r[1], r[0]] for r in first]
    results = [
        rows(readers.read_json_matrix(spark, put(tmp_path / f"{i}.json", json.dumps(m)), POPULATION))
        for i, m in enumerate((first, second))
    ]
    assert results == [[(5, "Ohio"), (7, "Utah")]] * 2
    empty = put(tmp_path / "empty.json", json.dumps(first[:1]))
    assert rows(readers.read_json_matrix(spark, empty, POPULATION)) == []


def test_json_matrix_without_a_column(spark, tmp_path):
    path = put(tmp_path / "x.json", json.dumps([["NAME"], ["Ohio"]]))
    with pytest.raises(PySparkException, match="no column POP_2021"):
        readers.read_json_matrix(spark, path, POPULATION).collect()


def test_csv_sink_keeps_staging_order(spark, tmp_path, rows):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 'x "q", y', 1, 2.0)], "d date, b string, a long, c double")
    path = str(tmp_path / "out")
    sinks.write_csv(df, path, LINES)
    header = next((tmp_path / "out").glob("*.csv")).read_text().splitlines()[0]
    assert header == "a,b,c,d"
    assert rows(readers.stage_csv(spark, path, LINES)) == [(1, 'x "q", y', 2.0, dt.date(2020, 1, 1))]


def test_append_and_refresh(spark, rows):
    kinds = schema(x="long", y="text")
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    sinks.reset_tables(spark, {"t1": kinds})
    sinks.load_table(df, "t1")
    sinks.load_table(df, "t1")
    assert rows(spark.table("t1")) == [(1, "a"), (1, "a")]
    sinks.reset_tables(spark, {"t1": kinds})
    assert rows(spark.table("t1")) == []
    for _ in range(2):
        sinks.replace_table(df.select("y", "x"), "t1", kinds)
        assert rows(spark.table("t1")) == [(1, "a")]
    sinks.replace_table(spark.table("t1").unionAll(df), "t1", kinds)
    assert rows(spark.table("t1")) == [(1, "a"), (1, "a")]
    assert rows(sinks.table_counts(spark, ["t1"])) == [("t1", 2)]


def test_batches_load_once(spark, rows):
    kinds = schema(x="long", y="text")
    df = spark.createDataFrame([("a", 1, True), ("b", 2, True)], "y string, x long, extra boolean")
    sinks.create_batch_table(spark, "t3", kinds)
    sinks.create_batch_table(spark, "t3", kinds)
    for batch in ("one", "two", "one"):
        sinks.load_batch(df, "t3", batch)
    assert rows(sinks.batch_rows(spark, "t3")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    # A rerun with other rows replaces those of its batch; one without rows leaves them.
    sinks.load_batch(df.where("x = 2"), "t3", "one")
    sinks.load_batch(df.limit(0), "t3", "two")
    assert rows(sinks.batch_rows(spark, "t3")) == [(1, "a"), (2, "b"), (2, "b")]
    assert sinks.loaded_batches(spark, "t3") == ["one", "two"]
    with pytest.raises(ValueError, match="needs a name"):
        sinks.load_batch(df, "t3", "")
    # A load that fails leaves what its batch had.
    broken = df.withColumn("x", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(PySparkException, match="broken"):
        sinks.load_batch(broken, "t3", "two")
    assert rows(sinks.batch_rows(spark, "t3")) == [(1, "a"), (2, "b"), (2, "b")]


def test_failed_refresh_keeps_the_old_table(spark, rows):
    kinds = schema(x="long")
    sinks.replace_table(spark.createDataFrame([(1,)], "x long"), "t2", kinds)
    broken = spark.createDataFrame([("q",)], "x string")
    with pytest.raises(PySparkException):
        sinks.replace_table(broken, "t2", kinds)
    assert rows(spark.table("t2")) == [(1,)]


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/x-") and a != b
