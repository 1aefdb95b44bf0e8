"""The operators' registered queries, each over its whole table, and the SQL of those that have some."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateline.llm.best_fit_packing import best_fit_packing
from stateline.llm.decontamination import contaminated, hit_words, with_matches
from stateline.llm.hard_negatives import hard_negatives
from stateline.llm.language_id import language_id
from stateline.llm.multi_index_hashing import nearest_neighbours
from stateline.llm.ngram_jaccard import ngram_jaccard, ngram_jaccard_links
from stateline.llm.prefix_trie import head_swapped, prefix_nodes, turn_sequences
from stateline.llm.quality_classifier import quality_classifier
from stateline.llm.source_mixing import source_mixing
from stateline.llm.substring_dedup import substring_dedup
from stateline.llm.token_counts import token_counts
from stateline.llm.toxicity import toxicity
from stateline.llm.url_filters import host_and_path, url_filters
from stateline.llm.workers import importable
from stateline.queries.registry import QueryFunction, table

QUERIES: dict[str, QueryFunction] = {}
SQL: dict[str, str] = {}

#: The rules the pages are judged by.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def _register(sql: str | None = None):
    def add(function: QueryFunction) -> QueryFunction:
        QUERIES[function.__name__] = lambda spark, folder: function(importable(spark), folder)
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


@_register()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(table(spark, folder, "documents"), limit=512)


@_register()
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens in sequences of 2048."""
    return best_fit_packing(table(spark, folder, "documents"), capacity=2048, end=0)


_URL_PARTS = r"""
    select page_id, url,
        case when url is null or not contains(url, '://') then ''
             else translate(regexp_extract(substr(url, instr(url, '://') + 3), '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as host,
        case when url is null or not contains(url, '://') then ''
             else regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) end as path
    from pages"""


@_register(
    f"""
    with u as ({_URL_PARTS}),
    rules(rule, rule_host, rule_path, verdict) as (values
        {", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in URL_RULES)}),
    judged as (
        select page_id, host, path,
            (select max({{'h': length(rule_host), 'p': length(rule_path), 'rule': rule, 'verdict': verdict}}) from rules
             where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as best
        from u)
    select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from judged"""
)
def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict by the rules."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filters(table(spark, folder, "pages"), rules, otherwise="allow")


_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@_register(
    f"""
    with d as (select row_number() over () as r, doc_id, regexp_extract_all({_SMALL}, {_ALNUM}) as w from documents),
    b as (select item_id, regexp_extract_all({_SMALL}, {_ALNUM}) as w from benchmark),
    windows as (
        select item_id, least(13, len(w)) as n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
            lambda i: list_aggregate(w[i : i + least(13, len(w)) - 1], 'string_agg', ' '))) as g
        from b where len(w) > 0),
    sizes as (select distinct n from windows),
    places as (
        select r, n, unnest(range(1, len(w) - n + 2)) as i, w from d, sizes where len(w) >= n),
    found as (
        select p.r, p.i, p.n, x.item_id
        from (select r, i, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') as g from places) p
        join windows x on x.n = p.n and x.g = p.g),
    hits as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from found) group by r),
    items as (
        select r, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct r, cast(item_id as varchar) as item from found) group by r)
    select doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(items, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) as contaminated
    from d left join hits using (r) left join items using (r)"""
)
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words that repeat a window of a benchmark item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, folder, "benchmark"), window=13)
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"].cast("string"))))
    items = F.filter(items, lambda i: i.isNotNull())
    found = found.select("doc_id", "n_words", hit_words(F.col("matches")).alias("n_hit"), items.alias("items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@_register(
    r"""
    with d as (select row_number() over () as r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
    places as (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50),
    windows as (select r, doc_id, i, md5(list_aggregate(w[i : i + 49], 'string_agg', ' ')) as g from places),
    least as (select g, min(doc_id) as least from windows group by g),
    gone as (
        select distinct r, unnest(range(i, i + 50)) as j
        from windows join least using (g) where doc_id > least),
    words as (select r, unnest(range(1, len(w) + 1)) as j, unnest(w) as word from d),
    kept as (
        select r, count(*) as n, string_agg(word, ' ' order by j) as text
        from words anti join gone using (r, j) group by r)
    select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
        sha256(coalesce(text, '')) as kept_sha256
    from d left join kept using (r)"""
)
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the runs of 50 words that a smaller document has."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = substring_dedup(docs, window=50, digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("text").alias("kept_sha256"))


@_register(
    r"""
    with recursive d as (
        select row_number() over () as r, doc_id,
            coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+'), []) as w
        from documents),
    grams as (
        select distinct r, md5(list_aggregate(w[i : i + 4], 'string_agg', ' ')) as g
        from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
    sizes as (select r, count(*) as n from grams group by r),
    links as (
        select a, b
        from (select x.r as a, y.r as b, count(*) as c from grams x join grams y on x.g = y.g and x.r <> y.r group by all)
        join sizes p on p.r = a join sizes q on q.r = b
        where 100 * c >= 75 * (p.n + q.n - c)),
    reach as (select r, r as s from d union select reach.r, b from reach join links on a = s)
    select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(e.doc_id) as component_id
    from d join reach using (r) join d e on e.r = reach.s left join sizes on sizes.r = d.r
    group by d.r, d.doc_id"""
)
def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component of near duplicates."""
    return ngram_jaccard(table(spark, folder, "documents"), n=5, percent=75)


@_register(
    SQL["op2_ngram_jaccard"].partition("    reach as")[0].rstrip().removesuffix(",")
    + """
    select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(k, 0) as n_links
    from d left join sizes using (r) left join (select a as r, count(*) as k from links group by a) using (r)"""
)
def op2_ngram_jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents each document links with, of all links."""
    found = ngram_jaccard_links(table(spark, folder, "documents"), n=5, percent=75)
    return found.documents.select("doc_id", "n_shingles", "n_links")


@_register()
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality, learned from the labels that are not held out."""
    return quality_classifier(table(spark, folder, "documents"), table(spark, folder, "labels"), threshold=0.3)


@_register()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's probabilities of the labelled categories, low quality first, then toxic."""
    labels = table(spark, folder, "labels").withColumn("low_quality", 1 - F.col("quality"))
    scored = toxicity(table(spark, folder, "documents"), labels, ["low_quality", "toxic"])
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


@_register()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language from its text, what it declares and its source."""
    docs = table(spark, folder, "documents")
    return language_id(docs, declared="lang", host="source")


@_register()
def pages_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's language from its text, its markup, the language in its address and its host."""
    host, path = host_and_path(F.col("url"))
    text = F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>|&\w+;", " ")
    pages = table(spark, folder, "pages").select("page_id", text.alias("text"), "html", host.alias("host"), path.alias("path"))
    markup = F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit(""))
    suffix = F.nullif(F.lower(F.regexp_extract("path", r"^/([A-Za-z]{2})(?:/|$)", 1)), F.lit(""))
    return language_id(pages, id="page_id", declared=markup, suffix=suffix, host="host")


@_register()
def op1_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows found for every vector whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


#: CRC-32 of an id's decimal digits, bit by bit: each byte meets the lowest bits, then eight shifts.
_CRC32 = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast({id} as varchar), ''),
            lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
        lambda crc, bit: xor(xor(crc, bit) >> 1, 3988292384 * (xor(crc, bit) & 1))))"""


@_register(
    f"""
    with own as (
        select conv_id, row_number() over (partition by conv_id order by turn nulls first) - 1 as pos,
            coalesce(role, '') as role, coalesce(text, '') as text
        from conversations where conv_id is not null),
    convs as (
        select conv_id, conv_id - conv_id % 5 as head, {_CRC32.format(id="conv_id")} % 9 as h
        from (select distinct conv_id from own)),
    rebuilt as (
        select c.conv_id, 0 as part, o.pos, role, text from convs c join own o on o.conv_id = c.head and o.pos < c.h
        union all
        select c.conv_id, 1, o.pos, role, text from convs c join own o on o.conv_id = c.conv_id and o.pos >= c.h),
    turns as (
        select conv_id, row_number() over (partition by conv_id order by part, pos) as d,
            md5(cast(strlen(role) as varchar) || ':' || role || text) as code, strlen(text) as size
        from rebuilt),
    listed as (select conv_id, max(d) as len, list(code order by d) as codes from turns group by conv_id),
    paths as (
        select conv_id, d, size, md5(list_aggregate(codes[1:d], 'string_agg', ',')) as k from turns join listed using (conv_id)
        union all select conv_id, 0, 0, '' from convs),
    whole as (select conv_id, coalesce(len, 0) as len from convs left join listed using (conv_id)),
    nodes as (
        select k, d, min(conv_id) as conv_id, count(*) as n, any_value(size) as size,
            string_agg(case when d = len then conv_id end, ',' order by conv_id) as ends
        from paths join whole using (conv_id) group by k, d),
    edges as (select distinct p.k as above, q.k as k, q.d from paths p join paths q on p.conv_id = q.conv_id and q.d = p.d + 1),
    children as (select above as k, count(*) as n_children from edges group by above),
    below as (select distinct p.k as above, q.k as k from paths p join paths q on p.conv_id = q.conv_id and q.d >= p.d),
    sums as (
        select above as k, count(*) filter (where n_children is null) as n_leaves, sum((n - 1) * size) as saved_tokens
        from below join nodes using (k) left join children using (k) group by above)
    select x.conv_id, cast(x.d as bigint) as depth, p.conv_id as parent_conv_id, x.n as n_convs, coalesce(n_children, 0) as n_children,
        n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(coalesce(x.ends, '')) as ends_sha256
    from nodes x left join edges e on e.k = x.k left join nodes p on p.k = e.above
    left join children c on c.k = x.k join sums s on s.k = x.k"""
)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of conversations that begin with up to eight turns of their family's first."""
    sequences = turn_sequences(table(spark, folder, "conversations"))
    return prefix_nodes(head_swapped(sequences, family=5, most=9, chosen=F.crc32(F.col("id").cast("string").cast("binary")) % 9))


@_register()
def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often a mix of 150% of all words takes each document."""
    return source_mixing(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, most=2)


@_register(
    """
    with v as (
        select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x
        from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    s as (
        select a.id as anchor_id, b.id as id, a.label = b.label as same,
            cast(list_dot_product(cast(a.x as double[]), cast(b.x as double[])) as bigint) as score
        from v a join v b on a.id <> b.id where a.id % 100 = 0),
    p as (
        select anchor_id, id as positive_id, score as positive_score from s where same
        qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
    n as (
        select p.*, s.id as negative_id, s.score as negative_score,
            row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id) as rank
        from p join s on s.anchor_id = p.anchor_id and not same
            and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
    select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5"""
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Five positives of every row whose id is divisible by 100, and five hard negatives of each."""
    rows = table(spark, folder, "embeddings")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.where(finite).select("vec_id", label.alias("label"), whole.alias("embedding"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, least_percent=80)
