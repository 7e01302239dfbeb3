"""Quality rules: an isolation forest on rule statistics, its threshold taken from labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import SPACES, arrow_schema, encoded, map_batches, partitions, record_batch, running_total, stored

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_distinct")
MIN_WORDS, REPEAT_PERCENT = 50, 50


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words within 3-word windows that occur at least twice, and the number of distinct words."""
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    n = len(numbers)
    if len(words) < 4:
        return 0, n
    if n < 2_000_000:
        keys = (at[:-2] * n + at[1:-1]) * n + at[2:]
    else:  # three numbers no longer fit in one of 64 bits
        pairs = np.unique(at[:-1] * n + at[1:], return_inverse=True)[1]
        keys = pairs[:-1] * n + at[2:]
    order = np.sort(keys)
    twice = order[1:] == order[:-1]
    if not twice.any():
        return 0, n
    again = np.isin(keys, np.unique(order[1:][twice]))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum()), n


def statistics_of(text: bytes) -> tuple[int, ...]:
    """The numbers of STATISTICS for one text in UTF-8."""
    words = text.split()
    without = lambda some: len(text) - len(text.translate(None, some))
    characters = len(text) if text.isascii() else len(text.decode())
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    repeated, distinct = repeated_words(words)
    return (
        len(words), characters - without(SPACES), without(SYMBOLS), len(lines) - len(set(lines)), repeated,
        len(lines), without(UPPER), without(MARKS), distinct,
    )


def features(stats: np.ndarray) -> np.ndarray:
    """What the forest looks at: ratios of the statistics, one row per document."""
    words, chars, symbols, dup_lines, repeated, lines, upper, marks, distinct = stats.T.astype(float)
    per_word, per_char = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack(
        [
            chars / per_word, symbols / per_word, dup_lines / np.maximum(lines, 1), repeated / per_word,
            upper / per_char, marks / per_char, distinct / per_word**0.8, words / np.maximum(lines, 1),
        ], axis=1,
    )


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > REPEAT_PERCENT * stats[:, 0])


def expected_depth(n: np.ndarray) -> np.ndarray:
    """The mean depth of a random binary tree over ``n`` rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays of a full binary tree each: feature, split and, where it ends, the path length."""

    knots: list[np.ndarray]
    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    threshold: float
    rows: int

    def ranks(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(k, values[:, j], side="left") / max(len(k), 1) for j, k in enumerate(self.knots)], axis=1)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """From 0 (deep in the usual) to 1 (isolated at once)."""
        ranks, rows = self.ranks(values), np.arange(len(values))
        total = np.zeros(len(values))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(values), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                right = ranks[rows, np.maximum(feature[node], 0)] >= split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / expected_depth(np.array(max(self.rows, 2))))

    def keeps(self, stats: np.ndarray) -> np.ndarray:
        kept = ~base_failed(stats)
        if np.isfinite(self.threshold) and kept.any():
            kept[kept] = self.scores(features(stats[kept])) <= self.threshold
        return kept


DEPTH, TREES = 9, 120
LEAVES = 2**DEPTH
KNOTS = 1024


def random_trees(knots: list[np.ndarray], seed: int) -> Forest:
    """Random splits over the range of all labelled rows, down to DEPTH, whatever the rows.

    Values become ranks among all labelled rows first, so a feature's few huge values do not take up all splits.
    """
    forest = Forest(knots, *(np.zeros((TREES, 2 * LEAVES), t) for t in (np.int64, float, float)), float("inf"), 0)
    forest.feature[:] = -1
    random = np.random.default_rng(seed)
    for tree in range(TREES):
        low, high = np.zeros((2 * LEAVES, len(knots))), np.ones((2 * LEAVES, len(knots)))
        for node in range(LEAVES - 1):
            f = int(random.integers(len(knots)))
            at = random.uniform(low[node, f], high[node, f])
            forest.feature[tree, node], forest.split[tree, node] = f, at
            for child in (2 * node + 1, 2 * node + 2):
                low[child], high[child] = low[node], high[node]
            high[2 * node + 1, f] = low[2 * node + 2, f] = at
    return forest


def leaf_counts(forest: Forest, values: np.ndarray) -> np.ndarray:
    """How many rows lie in each leaf of each tree of ``random_trees``."""
    ranks, rows = forest.ranks(values), np.arange(len(values))
    counts = np.zeros((TREES, LEAVES), np.int64)
    for tree in range(TREES):
        node = np.zeros(len(values), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (ranks[rows, forest.feature[tree, node]] >= forest.split[tree, node])
        counts[tree] = np.bincount(node - (LEAVES - 1), minlength=LEAVES)
    return counts


def set_paths(forest: Forest, counts: np.ndarray) -> None:
    """Path lengths from the clean rows in each leaf: a path ends where at most one row is left, or at DEPTH."""
    for depth in range(DEPTH, -1, -1):
        nodes = np.arange(2**depth - 1, 2 ** (depth + 1) - 1)
        forest.path[:, nodes] = depth + expected_depth(counts)
        forest.feature[:, nodes] = np.where(counts <= 1, -1, forest.feature[:, nodes])
        if depth:
            counts = counts.reshape(TREES, -1, 2).sum(axis=2)
    forest.rows = int(counts[0, 0])


def grow(clean: np.ndarray, every: np.ndarray, seed: int) -> Forest:
    """A forest over the range of all labelled rows, path lengths from all clean ones."""
    forest = random_trees([np.sort(column)[:: max(1, len(column) // KNOTS)] for column in every.T], seed)
    set_paths(forest, leaf_counts(forest, clean))
    return forest


def threshold_of(scores: np.ndarray, good: np.ndarray, clean_kept: float) -> float:
    """Among thresholds that keep ``clean_kept`` of the clean rows, the mildest with the most rejected bad rows."""
    candidates = np.unique(scores[good])
    kept = np.searchsorted(np.sort(scores[good]), candidates, side="right") / good.sum()
    candidates = candidates[kept >= clean_kept]
    rejected = (~good).sum() - np.searchsorted(np.sort(scores[~good]), candidates, side="right")
    best = candidates[rejected == rejected.max()]
    above = scores[scores > best[-1]]
    return float((best[-1] + above.min()) / 2) if len(above) else float(best[-1])


def calibrated(stats: np.ndarray, good: np.ndarray, clean_kept: float, seed: int) -> Forest | None:
    """A forest with the threshold that tells labelled rows apart best while it keeps the clean ones.

    Among thresholds that keep at least ``clean_kept`` of the clean rows, the one with the most rejected bad rows, and
    of those the mildest. Rows the base rules reject take no part. None without both kinds of rows.
    """
    passing = ~base_failed(stats)
    stats, good = stats[passing], good[passing]
    if len(stats) < 2 or good.all() or not good.any():
        return None
    values = features(stats)
    half = np.arange(len(stats)) % 2 == 0  # trees from one half of the clean rows, the threshold from all others
    fit = good & half if (good & half).any() else good
    forest = grow(values[fit], values, seed)
    judged = ~fit if (good & ~fit).any() and (~good).any() else np.ones(len(stats), bool)
    forest.threshold = threshold_of(forest.scores(values[judged]), good[judged], clean_kept)
    return forest


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the numbers of STATISTICS for every whole text; a null text has none of anything."""

    def run(columns: dict) -> dict:
        table = np.array([statistics_of(t) for t in encoded(columns["text"])], np.int64)
        return {"id": columns["id"]} | {name: table[:, k] for k, name in enumerate(STATISTICS)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "id long, " + ", ".join(f"{n} long" for n in STATISTICS))


def _with_before(counts: DataFrame, group: str, value: str) -> DataFrame:
    """Adds ``before``, the sum of ``n`` over the smaller values of a group; each value is there once per group.

    Values are dealt into ranges, sums per range are few, and within a range they are added up by a window.
    """
    ranged = counts.repartitionByRange(partitions(counts.sparkSession), group, value).withColumn("part", F.spark_partition_id())
    placed = stored(ranged, "quality-ranges")
    totals = placed.groupBy(group, "part").agg(F.sum("n").alias("n"))
    offsets = running_total(totals, [group], "part", "n", "offset").drop("n")
    within = Window.partitionBy(group, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(F.broadcast(offsets), [group, "part"]).withColumn("before", F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0)))


def _knots(values: DataFrame, total: int) -> list[np.ndarray]:
    """Of the sorted values of each feature, over all rows, those at even distances."""
    step, names = max(1, total // KNOTS), [c for c in values.columns if c.startswith("f")]
    counts = values.select(F.posexplode(F.array(*names)).alias("feature", "value")).groupBy("feature", "value").agg(F.count("*").alias("n"))
    hits = F.expr(f"(before + n + {step - 1}) div {step} - (before + {step - 1}) div {step}")
    rows = _with_before(counts, "feature", "value").withColumn("hits", hits).where("hits > 0").select("feature", "value", "hits").collect()
    # At most 2 * KNOTS a feature.
    found = [sorted((r["value"], r["hits"]) for r in rows if r["feature"] == k) for k in range(len(names))]
    return [np.repeat([v for v, _ in f], [h for _, h in f]) for f in found]


def _leaf_counts(forest: Forest, values: DataFrame) -> np.ndarray:
    """As ``leaf_counts`` over all rows; a task sends its sums only."""
    spec = "leaf int, n long"
    schema = arrow_schema(values.sparkSession, spec)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(TREES * LEAVES, np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += leaf_counts(forest, np.stack([c.to_numpy() for c in batch.columns], axis=1)).ravel()
        held = np.flatnonzero(counts)
        yield record_batch({"leaf": held, "n": counts[held]}, schema)

    counts = np.zeros(TREES * LEAVES, np.int64)
    for r in values.mapInArrow(tally, spec).groupBy("leaf").agg(F.sum("n").alias("n")).collect():  # one row per leaf
        counts[r["leaf"]] = r["n"]
    return counts.reshape(TREES, LEAVES)


def _threshold(scores: DataFrame, clean_kept: float) -> float:
    """As ``threshold_of`` over all rows of ``score`` and ``good``."""
    ones = lambda which: F.sum(F.when(which, 1).otherwise(0))
    counts = scores.groupBy("score").agg(ones(F.col("good")).alias("n"), ones(~F.col("good")).alias("bad")).withColumn("every", F.lit(0))
    ranked = stored(_with_before(counts, "every", "score"), "quality-ranked")
    clean = ranked.agg(F.sum("n")).first()[0]
    least = ranked.where("n > 0").where((F.col("before") + F.col("n")) / F.lit(float(clean)) >= clean_kept).agg(F.min("score")).first()[0]
    bad = ranked.where("bad > 0").where(F.col("score") > least).agg(F.min("score")).first()[0]
    mild = ranked.where("n > 0") if bad is None else ranked.where("n > 0").where(F.col("score") < bad)
    best = mild.agg(F.max("score")).first()[0]
    above = ranked.where(F.col("score") > best).agg(F.min("score")).first()[0]
    return float(best if above is None else (best + above) / 2)


def _fit(known: DataFrame, clean_kept: float, seed: int) -> Forest | None:
    """``calibrated`` over all labelled rows, as Spark jobs: ranks, the rows in each leaf, and the threshold are exact."""
    passing = known.where(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {REPEAT_PERCENT} * n_words")

    def ratios(columns: dict) -> dict:
        table = features(np.stack([columns[n].to_numpy() for n in STATISTICS], axis=1))
        return {"good": columns["good"], "half": columns["half"]} | {f"f{k}": table[:, k] for k in range(table.shape[1])}

    names = [f"f{k}" for k in range(8)]
    marked = passing.select(*STATISTICS, (F.col("quality") > 0).alias("good"), (F.xxhash64("id").bitwiseAND(1) == 0).alias("half"))
    spec = "good boolean, half boolean, " + ", ".join(f"{n} double" for n in names)
    values = stored(map_batches(marked, ratios, spec), "quality-ratios")
    found = {(r["good"], r["half"]): r["n"] for r in values.groupBy("good", "half").agg(F.count("*").alias("n")).collect()}
    total, clean = sum(found.values()), sum(n for (good, _), n in found.items() if good)
    if not 0 < clean < total:
        return None
    # Trees from one half of the clean rows, the threshold from all others.
    fit = F.col("good") & F.col("half") if (True, True) in found else F.col("good")
    judged = ~fit if {(True, True), (True, False)} <= set(found) else F.lit(True)
    forest = random_trees(_knots(values, total), seed)
    set_paths(forest, _leaf_counts(forest, values.where(fit).select(*names)))

    def score(columns: dict) -> dict:
        return {"score": forest.scores(np.stack([columns[n].to_numpy() for n in names], axis=1)), "good": columns["good"]}

    forest.threshold = _threshold(map_batches(values.where(judged), score, "score double, good boolean"), clean_kept)
    return forest


def fit_forest(
    stats: DataFrame, labels: DataFrame, sample_rows: int | None = None, clean_kept: float = 0.99, seed: int = 11
) -> Forest | None:
    """Fit on all labelled rows; only on request on those with the ``sample_rows`` smallest hashes of their id."""
    quality = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = stored(stats.join(quality, stats["id"] == quality["doc_id"]).select("id", *STATISTICS, "quality"), "quality-labelled")
    if sample_rows is None:
        return _fit(known, clean_kept, seed)
    rows = known.orderBy(F.xxhash64("id"), *STATISTICS).limit(sample_rows).select(*STATISTICS, "quality").collect()
    if not rows:
        return None
    table = np.array([tuple(r) for r in rows], np.int64)
    return calibrated(table[:, :-1], table[:, -1] > 0, clean_kept, seed)


def _verdict(forest: Forest | None, stats: np.ndarray) -> np.ndarray:
    return ~base_failed(stats) if forest is None else forest.keeps(stats)


def judge_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int | None = None,
    clean_kept: float = 0.99,
) -> DataFrame:
    """Rule statistics of every whole document, whether the base rules reject it, and the verdict.

    The base rules reject fewer than 50 words and texts over half of whose words lie in repeated 3-word windows. Of
    the others, a document is rejected if its mean path length over random splits of the statistics' ratios is so
    short that at most 1 - ``clean_kept`` of the clean labelled rows are like it.

    Returns ``id_col``, the numbers of STATISTICS, base_failed and kept. Defined cases: a null text has no words and fails; labels
    of one document that differ count as the worse one; without labels of both kinds the base rules alone
    decide; repeated rows and null ids get a row each; an empty table gives no rows; other columns are not looked at.
    """
    stats = stored(rule_statistics(docs, id_col, text_col), "quality")
    forest = fit_forest(stats, labels, sample_rows, clean_kept)

    def run(columns: dict) -> dict:
        table = np.stack([columns[n].to_numpy() for n in STATISTICS], axis=1)
        return columns | {"base_failed": base_failed(table), "kept": _verdict(forest, table)}

    schema = "id long, " + ", ".join(f"{n} long" for n in STATISTICS) + ", base_failed boolean, kept boolean"
    return map_batches(stats, run, schema).withColumnRenamed("id", id_col)


def passes(forest: Forest | None, text_col: str = "text") -> Column:
    """The verdict on a text as a column, to filter documents with all their columns."""

    @F.pandas_udf("boolean")
    def judge(texts):
        table = np.array([statistics_of((t or "").encode()) for t in texts], np.int64).reshape(-1, len(STATISTICS))
        return texts.__class__(_verdict(forest, table), index=texts.index)

    return judge(F.col(text_col))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that pass, with all their columns. The forest is fitted on the labelled ones among them.

    A null or empty text fails the base rules; repeated rows and null ids are judged by their texts like any other; without labelled
    rows only the base rules decide; an empty table gives no rows.
    """
    forest = fit_forest(stored(rule_statistics(docs, id_col, text_col), "quality"), labels)
    return docs.where(passes(forest, text_col))
