"""Operator 13, URL filters: rules first, gradient-boosted trees on lexical features beyond them.

The urls that a rule judges are the labelled ones. Trees learn from length, depth, digit
ratio, entropy, parameter counts and the statistics of suffixes, and judge what no rule fits.
Features are Spark expressions, the trees Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaval.llm.shared import keep


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str  # fits this host and its subdomains
    path: str  # and paths that begin so

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Trees:
    rows: int = 200_000  # labelled urls the trees see, about and at most; statistics see all
    trees: int = 20
    depth: int = 4
    step: float = 0.2
    folds: int = 4  # statistics of a training row come from the other folds
    prior: float = 4.0  # rows of the overall share added to each suffix
    seed: int = 13


#: Fixed values of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

_NUMBERS = (
    "url_length host_length path_length labels depth digit_ratio host_digit_ratio hyphens entropy"
    " parameters parameter_length has_fragment is_secure"
).split()
#: Suffix statistics: the last one, two and three labels of the host, and the end of the path.
#: Rules speak of host suffixes and path beginnings, so the path's first segment has one as well.
_SUFFIXES = ("top", "domain", "site", "ending", "segment")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without a url or without ``://``.

    The host ends at the first ``/``, ``?`` or ``#`` and only its A-Z are made lower case; the
    path goes on to the first ``?`` or ``#``.
    """
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judging_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Of the characters of a text, in nats: sorted, so that one pass counts them."""
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def weight(run: Column) -> Column:
        return F.when(run > 0, run * F.log(run)).otherwise(0.0)

    def step(state: Column, char: Column) -> Column:
        same = state["last"] == char
        return F.struct(
            char.alias("last"),
            F.when(same, state["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
            F.when(same, state["sum"]).otherwise(state["sum"] + weight(state["run"])).alias("sum"),
        )

    def end(state: Column) -> Column:
        return state["sum"] + weight(state["run"])

    size = F.length(text)
    total = F.aggregate(F.array_sort(F.split(text, "")), start, step, end)
    return F.when(size > 0, F.log(size) - total / size).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path and more) with the numbers and suffixes of each url."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    digits = "[^0-9]"
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.length(url)

    def share(part: Column, whole: Column) -> Column:
        return F.when(F.length(whole) > 0, F.length(part) / F.length(whole)).otherwise(0.0)

    return pages.withColumns(
        {
            "url_length": size,
            "host_length": F.length(host),
            "path_length": F.length(path),
            "labels": F.size(F.split(host, r"\.")),
            "depth": F.length(path) - F.length(F.replace(path, F.lit("/"))),
            "digit_ratio": share(F.regexp_replace(url, digits, ""), url),
            "host_digit_ratio": share(F.regexp_replace(host, digits, ""), host),
            "hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"))),
            "entropy": _entropy(url),
            "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
            "parameter_length": F.length(query),
            "has_fragment": F.contains(url, F.lit("#")).cast("int"),
            "is_secure": F.startswith(F.lower(url), F.lit("https:")).cast("int"),
            "top": F.substring_index(host, ".", -1),
            "domain": F.substring_index(host, ".", -2),
            "site": F.substring_index(host, ".", -3),
            "ending": F.regexp_extract(path, r"(?:\.[^./]*|/)\z", 0),
            "segment": F.regexp_extract(path, r"\A/[^/]*/?", 0),
        }
    ).withColumns({c: F.col(c).cast("double") for c in _NUMBERS})


def _with_statistics(rows: DataFrame, stats: DataFrame, overall: float, trees: Trees, fold: Column | None) -> DataFrame:
    """Adds each suffix's smoothed share of blocked urls and how many urls it was seen with."""
    for suffix in _SUFFIXES:
        own = stats.where(F.col("kind") == suffix)
        own = own.select(F.col("suffix").alias(suffix), F.col("folds").alias("__folds"))
        rows = rows.join(own, suffix, "left")
        part = F.col("__folds") if fold is None else F.filter("__folds", lambda f: f["fold"] != fold)
        part = F.coalesce(part, F.expr("cast(array() as array<struct<fold: int, n: bigint, blocked: bigint>>)"))
        n = F.aggregate(part, F.lit(0).cast("long"), lambda a, f: a + f["n"])
        blocked = F.aggregate(part, F.lit(0).cast("long"), lambda a, f: a + f["blocked"])
        rows = rows.withColumns(
            {
                f"{suffix}_share": (blocked + trees.prior * overall) / (n + trees.prior),
                f"{suffix}_seen": F.log1p(n.cast("double")),
            }
        ).drop("__folds")
    return rows


_FEATURES = [*_NUMBERS, *(f"{s}_{k}" for s in _SUFFIXES for k in ("share", "seen"))]


def _score(labelled: DataFrame, open_rows: DataFrame, trees: Trees) -> DataFrame:
    """``open_rows`` with ``score``, the trees' probability of block.

    ``labelled`` holds different urls with their features and ``label`` (1.0: block).
    """
    sums = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = sums["n"], sums["blocked"] or 0.0
    if blocked in (0.0, n):
        return open_rows.withColumn("score", F.lit(1.0 if n and blocked else 0.0))
    fold = F.pmod(F.xxhash64("url"), F.lit(trees.folds)).cast("int")
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("suffix")) for s in _SUFFIXES]))
    counts = labelled.select(fold.alias("fold"), "label", each.alias("k")).groupBy("k.kind", "k.suffix", "fold")
    counts = counts.agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("blocked"))
    stats = counts.groupBy("kind", "suffix").agg(F.collect_list(F.struct("fold", "n", "blocked")).alias("folds"))
    stats = keep(stats, "suffixes")

    part = F.pmod(F.xxhash64("url", F.lit(trees.seed)), F.lit(1 << 20)) < int(trees.rows / n * (1 << 20))
    seen = labelled.where(part) if n > trees.rows else labelled
    vector = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    seen = vector.transform(_with_statistics(seen, stats, blocked / n, trees, fold)).select("url", "features", "label")
    # Ordered, so that a rerun meets the same rows in the same places.
    seen = keep(seen.repartition(8, "url").sortWithinPartitions("url"), "labelled_urls")
    model = GBTClassifier(maxIter=trees.trees, maxDepth=trees.depth, stepSize=trees.step, seed=trees.seed).fit(seen)
    scored = model.transform(vector.transform(_with_statistics(open_rows, stats, blocked / n, trees, None)))
    return scored.withColumn("score", vector_to_array("probability")[1])


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, trees: Trees = Trees()) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each row of ``pages`` (page_id, url).

    The verdict is that of the longest rule that fits; where none does, the trees block from a
    score (probability of block) of 0.5. Rows judged by a rule have no score. Each different
    judged url counts once in training, however often it occurs. Where the rules block all
    they judge, or allow all, everything else is judged alike; where they judge nothing, all is
    allowed. A null url and one without ``://`` have an empty host and path, no rule fits them,
    and the trees judge what text there is. Urls are read whole. Repeated rows come as often as
    given, other columns are not read, and an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    named = named.withColumn("judged", judging_rule(F.col("host"), F.col("path"), rules))
    is_open = F.col("judged").isNull()
    labelled = named.where(~is_open).select("url", "host", "path", F.col("judged.verdict").alias("verdict"))
    label = (F.col("verdict") == "block").cast("double").alias("label")
    labelled = keep(lexical(labelled.distinct().select("url", "host", "path", label)), "judged_urls")
    # A url that many pages share is scored once.
    open_urls = lexical(named.where(is_open).select("url", "host", "path").distinct())
    scored = keep(_score(labelled, open_urls, trees).select("url", "score"), "scored_urls")
    joined = named.alias("n").join(scored.alias("s"), is_open & F.col("n.url").eqNullSafe(F.col("s.url")), "left")
    tried = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("judged.name").alias("rule"),
        F.coalesce("judged.verdict", tried).alias("verdict"), "score",
    )
