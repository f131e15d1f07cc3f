"""URL filters: rules by host and path, and gradient-boosted trees for the URLs that no rule decides.

Everything that touches rows is a native expression or aggregate. Features are lexical: lengths, depth,
share of digits, entropy of the characters, parameters, and how often URLs with the same host suffix and
the same file ending are blocked among the labelled ones. Labels are the rules' own verdicts, over all
rows. The trees are grown on a bounded sample of labelled feature rows (``SAMPLE``, by smallest hash),
which the driver reads as plain numbers, and come back as nested CASE expressions that run in generated
code.

Suffix statistics are joined, not collected; the statistics' side has a row for each suffix, so Spark
chooses a broadcast by its size or splits a suffix with very many rows.

Defined results: a null URL, and one without ``://``, has an empty host and path, no rule, and the
trees' verdict. Among rules of one length the first in the list wins. Without labels of both kinds the
trees say what labels there are, or allow. Repeated rows each get a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import below
from tidemark.session import ensure_checkpoint_dir

#: The training sample, the trees and their shape.
SAMPLE, TREES, DEPTH, BINS, RATE, LEAST = 20_000, 24, 3, 32, 0.3, 20
#: Rows by which a suffix's share leans to that of all labelled rows; folds by whose others a labelled row is counted.
PRIOR, FOLDS = 20, 5
#: Rules are compiled into one expression; longer lists are refused.
MOST_RULES = 512

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host.lower(), slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule.of("block", "net/"), Rule.of("allow", "example.net/en/"), Rule.of("block", "example.com/de/"), Rule.of("allow", "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between ``://`` and the next ``/``, ``?``, ``#``, in lower case, and from there to
    ``?`` or ``#``; empty texts where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    text = verdict = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text) if text is None else text.when(fits, rule.text)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def entropy(text: Column) -> Column:
    """Bits of entropy of the characters: runs in the sorted characters, folded one after another."""
    chars = F.array_sort(F.split(text, ""))
    n = F.length(text).cast("double")

    def bits(run: Column) -> Column:
        return F.when(run > 0, -(run / n) * F.log2(run / n)).otherwise(0.0)

    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    folded = F.aggregate(
        chars,
        start,
        lambda a, c: F.when(a["last"] == c, F.struct(c.alias("last"), (a["run"] + 1.0).alias("run"), a["sum"].alias("sum"))).otherwise(
            F.struct(c.alias("last"), F.lit(1.0).alias("run"), (a["sum"] + bits(a["run"])).alias("sum"))
        ),
        lambda a: a["sum"] + bits(a["run"]),
    )
    return F.when(F.length(text) > 0, folded).otherwise(0.0)


FEATURES = ("f_length", "f_host_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_hyphens", "f_suffix", "f_ending")


def with_features(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, ruled (the rule's verdict), suffix, ending and the lexical features."""
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, ruled = matched(F.col("host"), F.col("path"), rules)
    url, size = F.col("url"), F.length("url")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = size - F.length(F.translate(url, "0123456789", ""))

    def count(text: Column, char: str) -> Column:
        return F.length(text) - F.length(F.translate(text, char, ""))

    return base.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        ruled.alias("ruled"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1).alias("ending"),
        size.cast("double").alias("f_length"),
        F.length("host").cast("double").alias("f_host_length"),
        F.regexp_count("path", F.lit("/[^/]+")).cast("double").alias("f_depth"),
        F.when(size > 0, digits / size).otherwise(0.0).alias("f_digits"),
        entropy(url).alias("f_entropy"),
        F.when(query == "", 0.0).otherwise(count(query, "&") + 1.0).alias("f_params"),
        count(F.col("host"), ".").cast("double").alias("f_labels"),
        count(F.col("host"), "-").cast("double").alias("f_hyphens"),
    )


def fold_of() -> Column:
    return F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(FOLDS))


def with_suffixes(rows: DataFrame) -> DataFrame:
    """The features with the shares of blocked URLs among the labelled ones of the same host suffix and of the same
    ending; a suffix without labels has the share of all. A labelled row's share leaves out its own fold, so its
    own label is never among its features."""
    labelled = rows.where(F.col("ruled").isNotNull()).select("suffix", "ending", (F.col("ruled") == "block").cast("double").alias("y"), fold_of().alias("fold"))
    # The share of all labelled URLs, 0.5 without any, as a scalar subquery.
    share, out = labelled.agg(F.coalesce(F.avg("y"), F.lit(0.5))).scalar(), rows
    for name in ("suffix", "ending"):
        sums = [F.array(*[F.sum(F.when(F.col("fold") == k, value).otherwise(0.0)) for k in range(FOLDS)]) for value in (F.col("y"), F.lit(1.0))]
        own = labelled.groupBy(name).agg(sums[0].alias("__blocked"), sums[1].alias("__n"))

        def others(counts: str) -> Column:
            mine = F.when(F.col("ruled").isNotNull(), F.element_at(counts, (fold_of() + 1).cast("int"))).otherwise(0.0)
            return F.coalesce(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) - mine, F.lit(0.0))

        out = out.join(own, name, "left").withColumn(f"f_{name}", (others("__blocked") + PRIOR * share) / (others("__n") + PRIOR)).drop("__blocked", "__n")
    return out


@dataclass
class Split:
    feature: str
    bound: float
    low: Split | float
    high: Split | float

    def sql(self) -> str:
        low, high = (x.sql() if isinstance(x, Split) else f"{x!r}D" for x in (self.low, self.high))
        return f"CASE WHEN {self.feature} <= {self.bound!r}D THEN {low} ELSE {high} END"


@dataclass
class Trees:
    bias: float
    splits: list[Split | float]

    def score(self) -> Column:
        """The probability of block, as an expression over the features."""
        total: Column = F.lit(self.bias)
        for tree in self.splits:
            total = total + (F.expr(tree.sql()) if isinstance(tree, Split) else F.lit(tree))
        return 1 / (1 + F.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = FEATURES) -> Trees:
    """Newton boosting of the logistic loss over histograms of the features' quantiles."""
    if not len(y):
        return Trees(-6.0, [])
    share = min(1 - 1e-3, max(1e-3, float(y.mean())))
    bias = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Trees(bias, [])
    bounds = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    bins = np.stack([np.searchsorted(b, x[:, k], "left") for k, b in enumerate(bounds)], axis=1)
    total, trees = np.full(len(y), bias), []

    def build(rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int) -> Split | float:
        g, h = slope[rows].sum(), curve[rows].sum()
        best = (1e-6, None, None)
        if depth and len(rows) >= 2 * LEAST:
            for k, b in enumerate(bounds):
                own = bins[rows, k]
                gs, hs, ns = (np.cumsum(np.bincount(own, weights=w, minlength=len(b) + 1))[:-1] for w in (slope[rows], curve[rows], np.ones(len(rows))))
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(ns < LEAST) | (len(rows) - ns < LEAST)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), k, int(gain.argmax()))
        if best[1] is None:
            value = float(-RATE * g / (h + 1))
            total[rows] += value
            return value
        _, k, at = best
        low = bins[rows, k] <= at
        return Split(names[k], float(bounds[k][at]), build(rows[low], slope, curve, depth - 1), build(rows[~low], slope, curve, depth - 1))

    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        trees.append(build(np.arange(len(y)), chance - y, chance * (1 - chance), DEPTH))
    return Trees(bias, trees)


def training_sample(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Features and label y of at most ``sample`` labelled rows, those with the smallest hashes.

    Rows with one page, host, path and lexical features are one, and the bound of the draw follows from the number of
    distinct ones: copies stand for as much as a single row does, and neither fill the sample nor leave it empty."""
    own = ("page_id", "host", "path", *(f for f in FEATURES if f not in ("f_suffix", "f_ending")))
    order = F.xxhash64(*own)
    labelled = rows.where(F.col("ruled").isNotNull()).withColumn("hash", order)
    # The count needs no suffixes' shares; Spark prunes their joins.
    distinct = labelled.select("hash").distinct().count()
    drawn = labelled.where(below(F.col("hash"), sample, distinct)).dropDuplicates(["hash"])
    return drawn.orderBy("hash").limit(sample).select(*FEATURES, (F.col("ruled") == "block").cast("double").alias("y"))


def fit(rows: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from a bounded sample of labelled feature rows."""
    found = training_sample(rows, sample).collect()
    table = np.array([tuple(r) for r in found], np.float64).reshape(-1, len(FEATURES) + 1)
    return grow(table[:, :-1], table[:, -1])


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' score for each row of ``pages``.

    ``pages`` is read once: the features are written to the checkpoint folder, and counts, sample and scores come
    from there."""
    ensure_checkpoint_dir(pages.sparkSession)
    rows = with_suffixes(with_features(pages, rules).checkpoint())
    scored = rows.withColumn("score", fit(rows, sample).score())
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
