"""Scoring documents by masked pseudo-likelihood with a bidirectional window network."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_schema, encoded, map_batches, record_batch, stored

#: Token classes: FREQUENT words of their own, and BUCKETS for all other words by their ending.
CLUSTERS, MEMBERS = 32, 32
BUCKETS = 128
FREQUENT = CLUSTERS * MEMBERS - BUCKETS
PAD = CLUSTERS * MEMBERS
REACH, WIDTH = 3, 16
OFFSETS = [o for o in range(-REACH, REACH + 1) if o]
#: Every position of every document is a training target, in ROUNDS passes over disjoint documents.
ROUNDS, BATCH = 2, 16384
RATE = 0.3
SLICE = 4096
FIXED = float(1 << 24)
#: So many of the words without a class of their own at most, the most frequent, have their shares looked up where a text is scored.
KNOWN = 200_000
#: Logarithms of word shares travel as whole numbers of this part of one, so their sum is the same in any order.
SHARE = float(1 << 32)


def bucket_of(word: bytes) -> int:
    return FREQUENT + zlib.crc32(word[-3:]) % BUCKETS


class Classes(dict):
    """Token class of a word, lower-cased in A-Z. Keeps a bounded number of the words without a class of their own."""

    LIMIT = 200_000

    def __init__(self, frequent: list[bytes]):
        super().__init__()
        self.frequent = {w: k for k, w in enumerate(sorted(frequent))}
        self.update(self.frequent)

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.LIMIT + FREQUENT:
            self.clear()
            self.update(self.frequent)
        found = self.frequent.get(word)
        self[word] = found = bucket_of(word) if found is None else found
        return found

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Network:
    """Embeddings weighted by offset and added, tanh, then a softmax over clusters and one within the cluster."""

    embed: np.ndarray  # (PAD + 1, WIDTH)
    weigh: np.ndarray  # (offsets, WIDTH)
    to_cluster: np.ndarray  # (WIDTH, CLUSTERS)
    to_member: np.ndarray  # (CLUSTERS, WIDTH, MEMBERS)
    cluster_bias: np.ndarray
    member_bias: np.ndarray  # (CLUSTERS, MEMBERS)
    squares: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def from_counts(cls, counts: np.ndarray, seed: int) -> Network:
        """The output biases give the classes' frequencies, so training starts from the unigram model."""
        random = np.random.default_rng(seed)
        table = (counts[:PAD] + 0.1).reshape(CLUSTERS, MEMBERS)
        embed = random.normal(0, 0.3, (PAD + 1, WIDTH))
        embed[PAD] = 0
        parts = (
            embed, np.full((len(OFFSETS), WIDTH), 0.5), np.zeros((WIDTH, CLUSTERS)), np.zeros((CLUSTERS, WIDTH, MEMBERS)),
            np.log(table.sum(axis=1) / table.sum()), np.log(table / table.sum(axis=1, keepdims=True)),
        )
        return cls(*(p.astype(np.float32) for p in parts))

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.weigh, self.to_cluster, self.to_member, self.cluster_bias, self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def with_values(self, values: np.ndarray) -> Network:
        parts, at = [], 0
        for p in self.parts:
            parts.append(values[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*parts)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = np.zeros((len(context), WIDTH), np.float32)
        for k, weight in enumerate(self.weigh):
            total += (self.embed * weight)[context[:, k]]
        return np.tanh(total)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        h = self.hidden(context)
        cluster, member = target // MEMBERS, target % MEMBERS
        result = _log_share(h @ self.to_cluster + self.cluster_bias, cluster)
        order, runs = _by_cluster(cluster)
        h, member, found = h[order], member[order], np.zeros(len(h), result.dtype)
        for c, a, b in runs:
            found[a:b] = _log_share(h[a:b] @ self.to_member[c] + self.member_bias[c], member[a:b])
        result[order] += found
        return result.astype(float)

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One step of Adagrad on the mean conditional log-probability of a batch."""
        n = len(target)
        h = self.hidden(context)
        cluster, member = target // MEMBERS, target % MEMBERS
        wrong = _shares(h @ self.to_cluster + self.cluster_bias)
        wrong[np.arange(n), cluster] -= 1
        back = wrong @ self.to_cluster.T
        grads = [np.zeros_like(p) for p in self.parts]
        ones = np.ones(n, h.dtype)  # a product with ones adds up columns faster than a sum does
        grads[2], grads[4] = h.T @ wrong, ones @ wrong
        order, runs = _by_cluster(cluster)
        near, member, more = h[order], member[order], np.empty_like(back)
        for c, a, b in runs:
            own = _shares(near[a:b] @ self.to_member[c] + self.member_bias[c])
            own[np.arange(b - a), member[a:b]] -= 1
            grads[3][c], grads[5][c] = near[a:b].T @ own, ones[a:b] @ own
            more[a:b] = own @ self.to_member[c].T
        back[order] += more
        back *= 1 - h * h
        columns = np.ascontiguousarray(back.T, float)
        for k, weight in enumerate(self.weigh):
            word = np.ascontiguousarray(context[:, k])
            # What arrives at each word from this offset: one sum per word and dimension.
            arrived = np.stack([np.bincount(word, weights=c, minlength=PAD + 1) for c in columns], axis=1).astype(np.float32)
            grads[1][k] = (self.embed * arrived).sum(axis=0)
            grads[0] += arrived * weight
        grads[0][PAD] = 0
        if not self.squares:
            self.squares = [np.full_like(p, 1e-3) for p in self.parts]
        for p, g, s in zip(self.parts, grads, self.squares, strict=True):
            g /= n
            s += g * g
            p -= RATE * g / np.sqrt(s)


#: Inputs of the softmax beyond this, which no trained network comes near, are taken for it: their exponentials stay finite.
STEEP = 80.0


def _shares(x: np.ndarray) -> np.ndarray:
    """The softmax of each row, in place. A product with ones adds up rows faster than a sum does."""
    np.exp(np.clip(x, -STEEP, STEEP, out=x), out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def _log_share(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    np.clip(x, -STEEP, STEEP, out=x)
    own = x[np.arange(len(x)), chosen]
    return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def _by_cluster(cluster: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by cluster, and where each cluster's run begins and ends in it."""
    cluster = cluster.astype(np.int8)  # sorted by radix
    order = np.argsort(cluster, kind="stable")
    edges = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]


def contexts(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The classes around each place, outside the text PAD; never the place itself."""
    padded = np.r_[np.full(REACH, PAD), tokens, np.full(REACH, PAD)]
    return padded[at[:, None] + REACH + np.array(OFFSETS)]


def score_tokens(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """The sum over all tokens of their log-probability given both sides, for each text."""
    totals = np.zeros(len(texts))
    pending: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> None:
        if pending:
            owners = np.concatenate([np.full(len(t), k) for k, _, t in pending])
            values = network.log_probabilities(np.concatenate([c for _, c, _ in pending]), np.concatenate([t for _, _, t in pending]))
            np.add.at(totals, owners, values)
            pending.clear()

    for k, tokens in enumerate(texts):
        for begin in range(0, len(tokens), BATCH):
            at = np.arange(begin, min(begin + BATCH, len(tokens)))
            pending.append((k, contexts(tokens, at), tokens[at]))
            held += len(at)
            if held >= BATCH:
                flush()
                held = 0
    flush()
    return totals


class Scored(dict):
    """A number for each word: its class, its place among the known words above the classes, or less than 0 for a rare one of
    that bucket. Keeps a bounded number of rare words."""

    LIMIT = 200_000

    def __init__(self, frequent: list[bytes], known: dict[bytes, int]):
        super().__init__()
        self.fixed = {w: k for k, w in enumerate(sorted(frequent))} | {w: PAD + 1 + k for k, w in enumerate(known)}
        self.update(self.fixed)
        self.classes = np.array([bucket_of(w) for w in known], np.int64)
        self.values = np.array(list(known.values()), np.int64)

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.LIMIT + len(self.fixed):
            self.clear()
            self.update(self.fixed)
        self[word] = found = -bucket_of(word)
        return found

    def of(self, text: bytes) -> tuple[np.ndarray, int, list[bytes]]:
        """The classes of a text's words, the summed shares of its known words, and its rare words."""
        words = text.lower().split()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        known = numbers > PAD
        places = numbers[known] - PAD - 1
        rare = numbers < 0
        tokens = np.abs(numbers)
        tokens[known] = self.classes[places]
        return tokens, int(self.values[places].sum()), [words[k] for k in np.flatnonzero(rare).tolist()]


@dataclass
class Shares:
    """For each bucket its tokens and distinct words, the logarithms of known words' shares, and the counts of the rare ones (word, n)."""

    rare: DataFrame
    known: dict[bytes, int]
    tokens: np.ndarray
    distinct: np.ndarray

    def unseen(self, bucket: int) -> float:
        """Each word counts once more than it is there, and one word stands for all unseen ones."""
        return -math.log(self.tokens[bucket] + self.distinct[bucket] + 1)

    def value(self, word: bytes, n: int) -> int:
        return round(SHARE * (math.log(n + 1) + self.unseen(bucket_of(word) - FREQUENT)))


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7) - (1 << 63)


def _vocabulary(rows: DataFrame) -> tuple[list[bytes], np.ndarray, Shares]:
    """The most frequent words of the whole corpus, how often each class occurs, and the other words' shares."""

    def count(columns: dict) -> dict:
        found: Counter[bytes] = Counter()
        for text in encoded(columns["text"]):
            found.update(text.lower().split())
        return {"word": list(found), "n": list(found.values())}

    counts = stored(map_batches(rows.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = sorted(bytes(r["word"]) for r in top)
    table = np.zeros(PAD + 1)
    own = {w: k for k, w in enumerate(frequent)}
    for r in top:
        table[own[bytes(r["word"])]] = r["n"]

    def rest(columns: dict) -> dict:
        sums, words = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for word, n in zip(columns["word"].to_pylist(), columns["n"].to_pylist(), strict=True):
            if word not in own:
                sums[bucket_of(word) - FREQUENT] += n
                words[bucket_of(word) - FREQUENT] += 1
        return {"bucket": np.arange(BUCKETS), "n": sums, "words": words}

    distinct = np.zeros(BUCKETS)
    buckets = map_batches(counts, rest, "bucket long, n long, words long").groupBy("bucket").agg(F.sum("n"), F.sum("words"))
    for bucket, n, words in buckets.collect():
        table[FREQUENT + bucket], distinct[bucket] = n, words
    # Sixteen levels for each doubling of a count, so a table of bounded size tells from which level on words are few enough.
    level = F.floor(F.log2("n") * 16)
    sizes = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)
    least, held = 1 << 20, 0
    for row in sizes:
        held += row["count"]
        if held > KNOWN:
            break
        least = row["level"]
    shares = Shares(counts.where(level < least), {}, table[FREQUENT:PAD], distinct)
    near = counts.where(level >= least).orderBy("word").collect()
    shares.known = {w: shares.value(w, r["n"]) for r in near if (w := bytes(r["word"])) not in own}
    return frequent, table, shares


NUMBERED = "id long, k1 long, k2 long, mark long, tokens binary, value long, word array<long>, times array<long>, unseen array<long>"


def _numbered(rows: DataFrame, frequent: list[bytes], shares: Shares | None) -> DataFrame:
    """Texts as the classes of their words in 16 bits, once for training and scoring; with the summed shares of their known words and
    their rare words, how often each is there, and what it counts for if the corpus does not have it."""
    known = shares.known if shares else {}
    unseen = [round(SHARE * shares.unseen(k)) for k in range(BUCKETS)] if shares else []
    shared: list[Scored] = []

    def number(columns: dict) -> dict:
        words = shared[0] if shared else Scored(frequent, known)
        shared[:] = [words]
        texts, values, rare = zip(*[words.of(t) for t in encoded(columns["text"])], strict=True)
        times = [Counter(r) for r in rare] if unseen else [Counter()] * len(rare)
        return {k: columns[k] for k in ("id", "k1", "k2", "mark")} | {
            "tokens": [t.astype("<i2").tobytes() for t in texts], "value": values,
            "word": [[_word_hash(w) for w in t] for t in times], "times": [list(t.values()) for t in times],
            "unseen": [[unseen[bucket_of(w) - FREQUENT] for w in t] for t in times],
        }

    return stored(map_batches(rows, number, NUMBERED), "pseudo-tokens")


def _tokens(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(data, "<i2").astype(np.int64) for data in column.to_pylist()]


def _rare_shares(numbered: DataFrame, frequent: list[bytes], shares: Shares) -> DataFrame:
    """For each text, by its two hashes, the summed logarithms of its rare words' shares in their buckets, over all rows of that text."""
    own = set(frequent)

    def valued(columns: dict) -> dict:
        some = [(w, n) for w, n in zip(columns["word"].to_pylist(), columns["n"].to_pylist(), strict=True) if w not in own]
        return {"word": [_word_hash(w) for w, _ in some], "value": [shares_only.value(w, n) for w, n in some]}

    shares_only = Shares(None, {}, shares.tokens, shares.distinct)
    words = numbered.select("k1", "k2", F.explode(F.arrays_zip("word", "times", "unseen")).alias("w")).select("k1", "k2", "w.*")
    table = map_batches(shares.rare, valued, "word long, value long")
    found = words.join(table, "word", "left").withColumn("value", F.coalesce("value", "unseen") * F.col("times"))
    return found.groupBy("k1", "k2").agg(F.sum("value").alias("value"))


def _trained(numbered: DataFrame, network: Network, round_: int) -> Network:
    """Train one network per task on all its documents of this round, then average them by their number of targets.

    Weights travel in slices as whole numbers in two halves, so the sum is the same in any order; tasks are summed in groups first.
    """
    spark = numbered.sparkSession
    schema = "slice int, task long, n long, sums binary"
    target = arrow_schema(spark, schema)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, first = network.with_values(network.flat()), 0, None
        around, wanted, held = [], [], 0
        for batch in batches:
            for tokens, mark in zip(_tokens(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                first = mark if first is None else first
                for begin in range(0, len(tokens), BATCH):
                    at = np.arange(begin, min(begin + BATCH, len(tokens)))
                    around.append(contexts(tokens, at)), wanted.append(tokens[at])
                    held += len(at)
                    if held >= BATCH:
                        around, wanted = [np.concatenate(around)], [np.concatenate(wanted)]
                        own.train(around[0][:BATCH], wanted[0][:BATCH])
                        seen += BATCH
                        around, wanted, held = [around[0][BATCH:]], [wanted[0][BATCH:]], held - BATCH
        if held:
            own.train(np.concatenate(around), np.concatenate(wanted))
            seen += held
        if seen:
            sums = np.round(own.flat().astype(float) * FIXED).astype(np.int64) * seen
            pieces = [np.r_[s >> 32, s & 0xFFFFFFFF].tobytes() for s in (sums[a : a + SLICE] for a in range(0, len(sums), SLICE))]
            k = len(pieces)
            yield record_batch({"slice": range(k), "task": [first & 0x3F] * k, "n": [seen] * k, "sums": pieces}, target)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.int64) for b in table.column("sums"))
        values = {"slice": [table.column("slice")[0].as_py()], "task": [table.column("task")[0].as_py()]}
        return pa.Table.from_batches([record_batch(values | {"n": [sum(table.column("n").to_pylist())], "sums": [total.tobytes()]}, target)])

    part = numbered.where(F.pmod(F.col("mark"), F.lit(ROUNDS)) == round_).select("tokens", F.shiftright("mark", 8).alias("mark"))
    sums = part.mapInArrow(fit, schema).groupBy("slice", "task").applyInArrow(add, schema)
    whole = sorted(sums.groupBy("slice").applyInArrow(add, schema).collect(), key=lambda r: r["slice"])
    if not whole:
        return network
    halves = [np.frombuffer(bytes(r["sums"]), np.int64).reshape(2, -1).astype(float) for r in whole]
    values = np.concatenate([(high * (1 << 32) + low) / r["n"] for (high, low), r in zip(halves, whole, strict=True)]) / FIXED
    return network.with_values(values)


def train_network(docs: DataFrame, text_col: str = "text", seed: int = 5) -> tuple[Network, list[bytes]]:
    """The network and the frequent words, without the shares of the others."""
    return train_model(docs, text_col, seed)[:2]


def train_model(docs: DataFrame, text_col: str = "text", seed: int = 5) -> tuple[Network, list[bytes], Shares]:
    """Word counts of all documents, then ROUNDS of training in which every token of every document is a target once."""
    return _model(_rows(docs, F.lit(None), text_col), seed)[:3]


def _rows(docs: DataFrame, doc_id: Column, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = F.xxhash64(text)
    keys = [first.alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), F.pmod(first, F.lit(1 << 40)).alias("mark")]
    return docs.select(doc_id.cast("long").alias("id"), text.alias("text"), *keys)


def _model(rows: DataFrame, seed: int = 5) -> tuple[Network, list[bytes], Shares, DataFrame]:
    """The model and the rows' texts as numbers."""
    frequent, counts, shares = _vocabulary(rows)
    numbered = _numbered(rows, frequent, shares)
    network = Network.from_counts(counts, seed)
    for round_ in range(ROUNDS):
        network = _trained(numbered, network, round_)
    return network, frequent, shares, numbered


def pseudo_likelihood(
    docs: DataFrame, model: tuple[Network, list[bytes]] | tuple[Network, list[bytes], Shares] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score every whole document by the summed log-probability of each token given its neighbours on both sides.

    Words (split at ASCII white space, A-Z lower-cased) are FREQUENT classes of their own and BUCKETS of others. A network
    predicts each class from the REACH classes before and after it; it is trained here on all documents unless given. A word
    without a class of its own has its share of the bucket, by its count, as a factor; a model given without shares scores classes.

    Returns ``id_col``, n_tokens, log_likelihood (0 without tokens) and mean_log_likelihood (null without tokens). Defined cases: a null
    or empty text has no tokens; repeated rows and null ids get a row each; an empty table gives no rows; other columns are not looked at.
    """
    rows = _rows(docs, F.col(id_col), text_col)
    if model is None:
        network, frequent, shares, numbered = _model(rows)
    else:
        network, frequent, *rest = model
        shares = rest[0] if rest else None
        numbered = _numbered(rows, frequent, shares)

    def run(columns: dict) -> dict:
        texts = _tokens(columns["tokens"])
        found = {"n_tokens": [len(t) for t in texts], "log_likelihood": score_tokens(network, texts)}
        return {k: columns[k] for k in ("id", "k1", "k2", "value")} | found

    given = numbered.select("id", "k1", "k2", "value", "tokens")
    scored = map_batches(given, run, "id long, k1 long, k2 long, value long, n_tokens long, log_likelihood double")
    if shares:
        sums = _rare_shares(numbered.where(F.size("word") > 0), frequent, shares).withColumnRenamed("value", "rare")
        # Rows of one text each add the same sum.
        each = sums.join(numbered.groupBy("k1", "k2").agg(F.count("*").alias("rows")), ["k1", "k2"])
        each = each.select("k1", "k2", (F.col("rare") / F.col("rows")).alias("rare"))
        whole = F.col("log_likelihood") + (F.col("value") + F.coalesce("rare", F.lit(0.0))) / SHARE
        scored = scored.join(each, ["k1", "k2"], "left").withColumn("log_likelihood", whole)
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.select(F.col("id").alias(id_col), "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))
