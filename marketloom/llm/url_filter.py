"""URL filters: host and path rules, and boosted trees on lexical features where no rule fits.

Everything is SQL functions and Spark's own tree learner; nothing runs in Python on the executors. Urls that a rule
decides are the labelled ones: statistics of suffixes, directories and sites count all of them, the trees learn from a
bounded sample and judge the rest. A url that the trees learn from meets statistics without its own fold, so that its own
label is not among its features; half of the hosts form whole folds, so the trees also learn what to do with sites that
no rule knows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from marketloom.llm.common import LOWER, UPPER, sampled


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules the query is asked to use.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

FEATURES = (
    "url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio", "hyphens", "entropy",
    "parameters", "has_fragment", "secure", "suffix_rate", "suffix_seen", "directory_rate", "directory_seen", "pair_rate",
    "pair_seen", "segment_rate", "segment_seen",
)

KEYS = {"suffix": None, "directory": None, "pair": "directory", "segment": "pair"}
"""What statistics are kept of: the host's last label, the path's first part, that part under that label, and on that host.
Each with the coarser one whose rate stands in where nothing is known, and is one url's worth of evidence elsewhere."""

FOLDS = 5
STEPS = 20
"""Rates are told in so many steps, numbers by their magnitude: exact ones would give away which fold a url is in."""


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` (A-Z lower-cased) and ``path``; both empty without ``://`` or for a null url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
    return host & F.startswith(F.col("path"), F.lit(rule.path))


def with_rule(parts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds ``rule`` (text of the longest rule that fits, else null) and ``rule_verdict``."""
    longest_first = sorted(rules, key=lambda r: (-len(r.text), r.text))
    none = F.lit(None).cast("string")
    return parts.withColumns({
        "rule": F.coalesce(none, *[F.when(fits(r), F.lit(r.text)) for r in longest_first]),
        "rule_verdict": F.coalesce(none, *[F.when(fits(r), F.lit(r.verdict)) for r in longest_first]),
    })


def _entropy(text: Column) -> Column:
    """Bits per character: one replacement per distinct character."""
    size = F.length(text).cast("double")
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    return F.aggregate(
        F.array_distinct(F.split(text, "")), F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c))
    )


def with_lexical(parts: DataFrame, url: str = "url") -> DataFrame:
    """Adds the features that a url has by itself, the keys of its statistics and its ``fold``."""
    text = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    size = F.length(text)
    first = F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit(""))
    by_host = F.pmod(F.xxhash64("host"), F.lit(2 * FOLDS))
    return parts.withColumns({
        "url_length": size.cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "host_labels": F.size(F.split("host", r"\.")).cast("double"),
        "path_depth": (F.length("path") - F.length(F.translate("path", "/", ""))).cast("double"),
        "digit_ratio": (size - F.length(F.translate(text, "0123456789", ""))) / F.greatest(size, F.lit(1)),
        "hyphens": (size - F.length(F.translate(text, "-", ""))).cast("double"),
        "entropy": F.when(size > 0, _entropy(text)).otherwise(0.0),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "has_fragment": F.when(F.instr(text, "#") > 0, 1.0).otherwise(0.0),
        "secure": F.when(F.startswith(text, F.lit("https:")), 1.0).otherwise(0.0),
        "suffix": F.substring_index("host", ".", -1),
        "directory": first,
        "pair": F.concat_ws("/", F.substring_index("host", ".", -1), first),
        "segment": F.concat_ws("/", F.col("host"), first),
        "fold": F.when(by_host < FOLDS, by_host).otherwise(FOLDS + F.pmod(F.xxhash64("page_id", text), F.lit(FOLDS))),
    })


def _counts(labelled: DataFrame, key: str, *by: str) -> DataFrame:
    """Per value of ``key`` the blocked and all urls; added up on the map side, so a hot suffix is one row."""
    return labelled.groupBy(key, *by).agg(F.sum("label").alias("blocked"), F.count("*").alias("seen"))


def with_statistics(urls: DataFrame, labelled: DataFrame, own_fold: bool = True) -> DataFrame:
    """Adds the smoothed share of blocked urls, and their number, per key; without ``own_fold`` those of the other folds."""
    for key, coarser in KEYS.items():
        whole = _counts(labelled, key)
        if own_fold:
            urls = urls.join(whole, key, "left")
        else:
            folds = _counts(labelled, key, "fold").withColumnsRenamed({"blocked": "own_blocked", "seen": "own_seen"})
            urls = urls.join(whole, key, "left").join(folds, [key, "fold"], "left").withColumns({
                f: F.col(f) - F.coalesce(f"own_{f}", F.lit(0)) for f in ("blocked", "seen")
            })
        seen = F.coalesce("seen", F.lit(0)).cast("double")
        expected = F.col(f"{coarser}_rate") if coarser else F.lit(0.5)
        urls = urls.withColumns({
            f"{key}_rate": (F.coalesce("blocked", F.lit(0.0)) + expected) / (seen + 1),
            f"{key}_seen": F.floor(F.log2(seen + 1)).cast("double"),
        }).drop("blocked", "seen", "own_blocked", "own_seen")
    return urls.withColumns({f"{key}_rate": F.floor(F.col(f"{key}_rate") * STEPS + 0.5) / STEPS for key in KEYS})


def train(labelled: DataFrame, trees: int = 20, depth: int = 4):
    """Boosted trees on ``FEATURES`` and ``label`` (1.0: block)."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(labelled)
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, minInstancesPerNode=5).fit(rows.select("features", "label"))


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", key: str = "page_id", train_rows: int = 20_000,
) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict``.

    The verdict is the longest fitting rule's, else that of trees trained on at most about ``train_rows`` urls that rules
    decide (chosen by a hash of the page and url); the statistics are those of all such urls. Null urls, urls without ``://`` and empty ones have empty host and path, no
    rule, and are judged by the trees like the rest. Repeated rows are judged alike. Without labelled urls of both
    verdicts nothing can be learned: the rest gets the only labelled verdict, or ``allow``. Other columns are ignored.
    """
    lexical = with_lexical(with_rule(with_parts(pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))), rules))
    labelled = lexical.where("rule is not null").withColumn("label", F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0))
    seen = labelled.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        learned = F.lit("block" if seen[0] == 1.0 else "allow")
        judged = lexical.withColumn("verdict", F.coalesce("rule_verdict", learned))
    else:
        rows = sampled(labelled, F.struct("page_id", "url"), train_rows)
        model = train(with_statistics(rows, labelled, own_fold=False).persist())
        rest = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_statistics(lexical, labelled))
        judged = model.transform(rest).withColumn(
            "verdict", F.coalesce("rule_verdict", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
        )
    return judged.select("page_id", "host", "path", "rule", "verdict")
