"""URL filters, with DataFrame functions only.

Rules list a verdict for a host (and its subdomains) and the beginning of a path. A blocked Bloom
filter of the rules' keys lets possible hits through, and an exact hash join removes the false ones.
The keys of a URL are its host's last labels and the beginning of its path, one for each shape
(number of labels, length of path) that occurs among the rules.

The filter is a table of blocks of 512 bits. It and the rules are broadcast if they are small by
count, else they are joined by shuffle, where Spark splits a skewed side.

Defined results: the longest rule wins, by host and path together; of equal lengths the longer
host, then the larger text. A url without a fitting rule is allowed. A null url or one without
`://` has an empty host and path, and so no rule. Repeated rows are judged each by itself. Rules
with a null host or path are left out; of rules for one key with both verdicts, `block` holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.shared import BROADCAST_BYTES

PATTERN = "(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHERWISE = "allow"
# The rules of the query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

WORDS, WORD_BITS, BITS_PER_KEY, PROBES = 8, 64, 16, 6


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PATTERN, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATTERN, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _probes(key: Column) -> list[Column]:
    """Places of a key in its block, nine bits each."""
    second = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(second, 9 * i).bitwiseAND(F.lit(WORDS * WORD_BITS - 1)) for i in range(PROBES)]


def blocked_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of the column `key`."""
    places = keys.select(_block(F.col("key"), blocks).alias("block"), F.explode(F.array(*_probes(F.col("key")))).alias("place"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % WORD_BITS).cast("int"))
    word = F.floor(F.col("place") / WORD_BITS)
    return places.groupBy("block").agg(*(
        F.coalesce(F.bit_or(F.when(word == w, mask)), F.lit(0).cast("long")).alias(f"w{w}") for w in range(WORDS)
    ))


def _possible(key: Column) -> Column:
    """Whether the joined block has all bits of the key."""
    words = F.array(*(F.col(f"w{w}") for w in range(WORDS)))
    found = F.lit(True)
    for place in _probes(key):
        word = F.get(words, F.floor(place / WORD_BITS).cast("int"))
        bit = F.call_function("shiftright", word, (place % WORD_BITS).cast("int")).bitwiseAND(F.lit(1))
        found = found & (bit == 1)
    return F.coalesce(found, F.lit(False))


def _small(table: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """A table to be broadcast if its rows are few enough."""
    return F.broadcast(table) if rows * row_bytes <= BROADCAST_BYTES else table


def judge(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of (page_id, url)."""
    spark = pages.sparkSession
    rules = rules_table(spark) if rules is None else rules
    rules = (
        rules.where("host is not null and path is not null")
        .groupBy(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))  # "block" is the larger text
        .withColumn("rule_key", F.concat_ws("\n", "rule_host", "rule_path"))
    )
    # One number for each shape; as many as rule hosts have label counts and rule paths have lengths.
    shapes = sorted(map(tuple, rules.select(_labels(F.col("rule_host")), F.length("rule_path")).distinct().collect()))
    n, longest = rules.agg(F.count("*"), F.coalesce(F.max(F.length("rule_key")), F.lit(0))).first()
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("row", F.monotonically_increasing_id())
    if not shapes:
        return parsed.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(OTHERWISE).alias("verdict"))
    blocks = -(-n * BITS_PER_KEY // (WORDS * WORD_BITS))
    keys = F.array(*(
        F.when((_labels(F.col("host")) >= labels) & (F.length("path") >= length),
               F.concat_ws("\n", F.substring_index("host", ".", -labels), F.substring("path", 1, length)))
        for labels, length in shapes
    ))
    candidates = parsed.withColumn("key", F.explode(keys)).withColumn("block", _block(F.col("key"), blocks))
    bloom = _small(blocked_filter(rules.select(F.col("rule_key").alias("key")), blocks), blocks, 8 * (WORDS + 1))
    passed = candidates.join(bloom, "block", "left").select(
        "row", "page_id", "host", "path", F.when(_possible(F.col("key")), F.col("key")).alias("key")
    )
    exact = passed.join(_small(rules, n, 4 * (longest + 16)), F.col("key") == F.col("rule_key"), "left")
    fitting = F.when(F.col("rule_key").isNotNull(), F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("length"), F.length("rule_host").alias("host_length"),
        F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"),
    ))
    # The rows of a page stand together, so the partial aggregation leaves one of them.
    best = exact.groupBy("row", "page_id", "host", "path").agg(F.max(fitting).alias("best"))
    return best.select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(OTHERWISE)).alias("verdict")
    )
