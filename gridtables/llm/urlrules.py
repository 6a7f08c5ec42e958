"""URL filtering: given rules by host and path, and for the rest association rules mined with Spark's FP-growth.

A url is a set of tokens: scheme, host labels and host suffixes, path segments by their shape, query names. Urls that the given
rules judge are the labelled ones. Support bounds what is mined: of their tokens the frequent ones, and of tokens that always stand
together one for all, are items. A token that only urls of one verdict hold is a rule of its own, which no longer one can better. FP-growth over the others, with the verdict as one more item, gives the frequent combinations; a rule "tokens -> verdict" stays if support and confidence reach their thresholds and no part of its tokens already
says as much. Rules match through an inverted index: token -> rules, a rule fits when all its tokens met.
Everything is DataFrame work: url to tokens, FP-growth, and joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.llm.common import staged

HOST_CHARS = 253  # of a host name at most; longer suffixes are told apart by digest
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 8 << 20


def _after_scheme(url: Column) -> Column:
    """Text after the first ``://``; null where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(rules: Sequence[tuple[str, str]], host_col: str = "host", path_col: str = "path") -> Column:
    """Struct (rule, verdict) of the longest of the stated rules that fits, else null. The list is a parameter of a few rules."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fits = (F.col(host_col) == name) | F.col(host_col).endswith("." + name)
        fits &= F.col(path_col).startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """Distinct tokens: the scheme, the first host label, all host labels and host suffixes, all path segments by shape (runs of digits
    are one), and all query names."""
    labels = F.split(host_col, r"\.")
    suffix = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(
        F.lit("host:"), F.when(F.length(suffix(n)) > HOST_CHARS, F.sha2(suffix(n), 256)).otherwise(suffix(n))))
    named = F.transform(labels, lambda s: F.concat(F.lit("label:"), s))
    segments = F.filter(F.split(path_col, "/"), lambda s: s != "")
    shapes = F.transform(segments, lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), F.regexp_replace(s, "[0-9]+", "0")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("query:"), F.regexp_extract(s, r"(?s)^([^=]*)", 1)))
    scheme = F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1))
    first = F.concat(F.lit("sub:"), F.get(labels, F.lit(0)))
    some = F.array_distinct(F.concat(F.array(scheme, first), named, suffixes, shapes, names))
    return F.when(F.instr(url, "://") > 0, some).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float, min_confidence: float, max_tokens: int) -> DataFrame:
    """Rules (rule_id, tokens, verdict, support, confidence) from rows of ``tokens`` and ``verdict``.

    Tokens that every labelled url holds say nothing and are left to the others. Transactions count each url. Rules longer than
    ``max_tokens`` are not formed: with the label the pattern length is a parameter of the method.
    """
    verdict = F.concat(F.lit("verdict="), F.col("verdict"))
    total = labelled.count()
    empty = labelled.sparkSession.createDataFrame([], "rule_id long, tokens array<string>, verdict string, support double, confidence double")
    if not total:
        return empty
    # which urls hold a token, as two sums of hashes of 64 bits
    digests = [F.xxhash64(*x).cast("decimal(38,0)") for x in (("tokens",), (F.lit(1), "tokens"))]
    held = labelled.select(F.explode("tokens").alias("token"), verdict.alias("verdict"), F.struct(*digests).alias("holder"))
    frequent = held.groupBy("token").agg(
        F.count("*").alias("n"), F.struct(F.sum("holder.col1"), F.sum("holder.col2")).alias("holders"), F.min("verdict").alias("low"), F.max("verdict").alias("high"))
    # at most average tokens per url / min_support of them
    useful = frequent.where((F.col("n") >= min_support * total) & (F.col("n") < total))
    # tokens of the same urls have the same rules: one of them is mined, and its rules are those of all
    alike = useful.groupBy("n", "holders").agg(F.array_sort(F.collect_list("token")).alias("members"), F.min("low").alias("low"), F.max("high").alias("high"))
    alike = staged(alike.select(F.get("members", F.lit(0)).alias("item"), "members", "n", "low", "high"))
    if alike.isEmpty():
        return empty
    sure = alike.where("low = high")
    kept = [r["item"] for r in alike.where("low < high").select("item").collect()]
    found = sure.select(F.array("item").alias("items"), F.col("n").alias("freq")).unionByName(
        sure.select(F.array("item", "low").alias("items"), F.col("n").alias("freq")))
    if kept:
        baskets = labelled.select(F.concat(F.array_intersect("tokens", F.array(*map(F.lit, kept))), F.array(verdict)).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(baskets)
        found = found.unionByName(model.freqItemsets.where(F.size("items") <= max_tokens + 1))
    is_verdict = lambda t: t.startswith("verdict=")
    split = found.select(
        F.array_sort(F.filter("items", lambda t: ~is_verdict(t))).alias("tokens"),
        F.get(F.filter("items", is_verdict), F.lit(0)).alias("verdict"), "freq")
    split = staged(split.where(F.size("tokens") > 0))
    both, alone = split.where("verdict IS NOT NULL"), split.where("verdict IS NULL").select("tokens", F.col("freq").alias("base"))
    rules = both.join(alone, "tokens").select(
        "tokens", F.regexp_replace("verdict", "^verdict=", "").alias("verdict"), (F.col("freq") / total).alias("support"),
        (F.col("freq") / F.col("base")).alias("confidence")).where(F.col("confidence") >= min_confidence)
    # a rule goes if leaving out one token keeps the confidence
    rules = staged(rules)
    shorter = rules.select("tokens", "verdict", "confidence").where(F.size("tokens") > 1).select(
        F.col("tokens").alias("whole"), "verdict", "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("tokens"))
    spare = shorter.join(rules.select("tokens", "verdict", F.col("confidence").alias("less")), ["tokens", "verdict"]).where(
        F.col("less") >= F.col("confidence")).select(F.col("whole").alias("tokens"), "verdict").distinct()
    rules = rules.join(spare, ["tokens", "verdict"], "left_anti")
    for i in range(max_tokens):
        members = alike.select(F.col("item").alias(f"item{i}"), F.explode("members").alias(f"token{i}"))
        rules = rules.withColumn(f"item{i}", F.get("tokens", F.lit(i))).join(members, f"item{i}", "left")
    rules = rules.withColumn("tokens", F.array_sort(F.array_compact(F.array(*(f"token{i}" for i in range(max_tokens))))))
    return staged(rules.select(F.xxhash64("tokens", "verdict").alias("rule_id"), "tokens", "verdict", "support", "confidence"))


def match(rows: DataFrame, key: str, rules: DataFrame) -> DataFrame:
    """Best rule of each key: highest confidence, then support, then more tokens, then verdict. Rows: key, tokens (distinct)."""
    index = rules.select("rule_id", "verdict", "support", "confidence", F.size("tokens").alias("needed"), F.explode("tokens").alias("token"))
    size = index.agg(F.sum(F.octet_length("token") + F.octet_length("verdict") + 40)).first()[0] or 0
    asked = rows.select(key, F.explode("tokens").alias("token"))
    index = F.broadcast(index) if size <= BROADCAST_BYTES else index
    met = asked.join(index, "token").groupBy(key, "rule_id").agg(
        F.count("*").alias("met"), *(F.first(c).alias(c) for c in ("needed", "verdict", "support", "confidence"))).where("met = needed")
    best = F.max_by(F.struct("verdict", "confidence", "rule_id"), F.struct("confidence", "support", "needed", "verdict", "rule_id"))
    return met.groupBy(key).agg(best.alias("best")).select(
        key, F.col("best.verdict").alias("mined"), F.col("best.confidence").alias("confidence"), F.col("best.rule_id").alias("mined_rule"))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", min_support: float = 0.01,
    min_confidence: float = 0.8, max_tokens: int = 3, default: str = "allow",
) -> DataFrame:
    """id, host, path, rule (the stated rule that judged, else null), verdict, confidence and id of the mined rule.

    A url that neither a stated nor a mined rule fits, null and empty ones included, gets ``default``. Repeated rows each give a row.
    Other columns are not read.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host(url), "path": path(url)})
    rows = rows.withColumns({"given": given_rule(rules), "tokens": tokens(url, F.col("host"), F.col("path"))})
    rows = staged(rows.select("id", "host", "path", "given", "tokens"))
    mined = mine(rows.where("given IS NOT NULL").select("tokens", F.col("given.verdict").alias("verdict")), min_support, min_confidence, max_tokens)
    # urls of the same tokens are judged once; they meet by all tokens
    shapes = staged(rows.where("given IS NULL").groupBy("tokens").agg(F.count("*").alias("urls")).withColumn("shape", F.monotonically_increasing_id()))
    by_shape = shapes.join(match(shapes, "shape", mined), "shape").select("tokens", "mined", "confidence", "mined_rule")
    return rows.join(by_shape, "tokens", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("given.rule").alias("rule"),
        F.coalesce("given.verdict", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("given").isNull(), F.col("confidence")).alias("confidence"),
        F.when(F.col("given").isNull(), F.col("mined_rule")).alias("mined_rule"))
