"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join (operator 5).

Everything is DataFrame functions. A rule is a host and the beginning of a path, ``host/path``; it fits
its host and all subdomains of it if the url's path begins with the rule's path. So a url has a bounded
list of canonical forms that a rule could equal: each suffix of its host at a dot, with each beginning
of its path that has the length of some rule's path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A block is one 64-bit word of the filter; a form sets this many of its bits.
BITS_PER_FORM = 6
FORMS_PER_BLOCK = 5
#: At most 8 MiB of filter are broadcast. A longer list fills it more; the join still removes every
#: false hit, there are only more of them.
MOST_BLOCKS = 1 << 20

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, CAPITALS, SMALL), path


def split_rules(rules: DataFrame) -> DataFrame:
    """``rule`` and ``verdict`` with ``rule_host``, ``rule_path`` and ``form``, one row per form.

    Rules are ``host/path`` texts; a null rule or verdict is none, and of two rows with one form the
    smallest (verdict, rule) counts.
    """
    at = F.instr("rule", "/")
    host = F.when(at > 0, F.substring("rule", F.lit(1), at - 1)).otherwise(F.col("rule"))
    path = F.when(at > 0, F.substring("rule", at, F.length("rule"))).otherwise("/")
    split = rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull()).select(
        "rule", "verdict", F.translate(host, CAPITALS, SMALL).alias("rule_host"), path.alias("rule_path")
    )
    split = split.withColumn("form", F.concat("rule_host", "rule_path"))
    best = F.min(F.struct("verdict", "rule", "rule_host", "rule_path")).alias("best")
    return split.groupBy("form").agg(best).select("form", "best.*")


def forms(host: Column, path: Column, lengths: Column) -> Column:
    """What a rule that fits the url can equal. ``lengths``: array of the lengths of the rules' paths."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def _block(number: Column, blocks: int) -> Column:
    return F.pmod(number, F.lit(blocks)).cast("int")


def _mask(form: Column) -> Column:
    """The bits of a form in its block, from a second hash."""
    number = F.xxhash64(form, F.lit("bits"))
    places = [F.shiftright(number, 6 * i).bitwiseAND(63).cast("int") for i in range(BITS_PER_FORM)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_filter(forms_of_rules: DataFrame, blocks: int) -> DataFrame:
    """One row with ``words``: the 64 bits of each block, in order."""
    words = forms_of_rules.groupBy(_block(F.xxhash64("form"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("form"))).alias("word"))
    every = forms_of_rules.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    # ``blocks`` entries, so the group of all of them is bounded.
    filled = every.join(words, "block", "left").select("block", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "word"))), lambda b: b["word"]).alias("words"))


def url_filters(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Per row of ``pages`` its id, ``host``, ``path``, the longest ``rule`` that fits and its ``verdict``.

    ``rules`` has ``rule`` and ``verdict``. The longest rule wins: the longer host, then the longer
    path. Where no rule fits, ``rule`` is null and the verdict is ``otherwise``: a url that is not
    listed passes. Null urls and urls without ``://`` have an empty host and path, and no rule. Null
    ids and repeated rows stay as they are; other columns are ignored.

    The possible forms of each url are tested against the filter before any row moves. Only rows
    with a possible hit are shuffled, each as a few short rows with a number of their own, so one
    frequent url spreads evenly. The exact join drops the false hits.
    """
    listed = split_rules(rules)
    n = listed.count()
    blocks = min(MOST_BLOCKS, 1 << max(0, (n // FORMS_PER_BLOCK).bit_length()))
    # As many lengths as the longest rule has characters at most.
    lengths = listed.agg(F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths")).scalar()

    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(id).alias("id"), host.alias("host"), path.alias("path"))
    words = bloom_filter(listed, blocks).scalar()

    def possible(form: Column) -> Column:
        mask = _mask(form)
        return F.get("words", _block(F.xxhash64(form), blocks)).bitwiseAND(mask) == mask

    rows = rows.withColumn("words", words).withColumn("lengths", lengths)
    rows = rows.withColumn("hits", F.filter(forms(F.col("host"), F.col("path"), F.col("lengths")), possible)).drop("words", "lengths")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    none = rows.where(F.size("hits") == 0).select("id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    hits = rows.where(F.size("hits") > 0).select("id", "host", "path", "row", F.explode("hits").alias("form"))
    best = F.struct(F.length("rule_host"), F.length("rule_path"), F.col("rule"), F.col("verdict"))
    exact = hits.join(listed, "form", "left").withColumn("best", F.when(F.col("rule").isNotNull(), best))
    exact = exact.groupBy("row", "id", "host", "path").agg(F.max("best").alias("best"))
    judged = exact.select("id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
    return none.unionByName(judged).withColumnRenamed("id", id)
