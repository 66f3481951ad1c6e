"""Toxicity by weak supervision.

1. Voters.  From a bounded sample of labelled training rows, words and word beginnings that stand
   out in toxic texts are dealt to many small lexicons.  Each lexicon is a voter that fires on
   texts with enough of its entries; so do a fixed list of insults and a few patterns (symbol noise,
   shouting, one word again and again), which need not be good.
2. Label model.  What a voter is worth is not read off the labels.  A generative model
   is fitted to the votes alone by expectation maximisation: a hidden class, for each voter how often it fires in
   either class (its accuracy), and its dependence on one other voter given the
   class (the correlations: a maximum spanning tree over conditional mutual information, so lexicons that fire
   together aren't counted twice).  It gives each sample text a posterior label.
3. Classifier.  A linear classifier on the shares of words and word beginnings is trained on the posterior
   labels (logistic loss on probabilities), and scores every whole text.  A score is a
   mean of word weights, so a worker looks each word up once.

The sample is the bounded part (``sample`` rows, by a hash of the id); with fewer training rows it is all
of them.  Near copies among its texts share one text's weight.  Labels, language, source and id are no
inputs of a score.  The model has at most ``MAX_WEIGHTS`` weights, a bound on what is broadcast.

Nulls and empty texts have no words: their score is the model's for no evidence.  Rows with
repeated or null ids each get their own row; only labelled rows with an id can be training rows.  With no training
rows of both classes, only the fixed list votes.  Other columns may be carried along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

WORD = regex.compile(r"\w+")
#: Lengths of the word beginnings that are features of their own.
STEMS = (4, 5, 6)
#: A fixed list of common insults, one voter's lexicon.
INSULTS = ("idiot moron stupid dumb fool loser scum trash garbage pathetic worthless disgusting clown "
           "imbecile jerk creep filth vermin freak ugly hate kill shut ignorant degenerate").split()
#: Training rows at most.
SAMPLE = 8192
#: Voters for words and for word beginnings, and entries of all lexicons of a kind.
LEXICONS, ENTRIES = 8, 400
#: Least log-likelihood ratio of a lexicon's entry: about one of a million features reaches it by chance.
LEAST_GAIN = 25.0
#: Least share of words that makes a lexicon fire.
SHARE = 1 / 500
#: Bits of a hashed feature, toxic texts that a lexicon's entry must be in, and weights at most.
HASH_BITS, MIN_TEXTS, MAX_WEIGHTS = 20, 3, 1 << 17
#: Least log-likelihood ratio of a feature of the classifier, and the penalty on squared weights.
TELLING, PENALTY = 25.0, 1e-3
#: A text's shares are counts over its words plus PAD, times SCALE.
PAD, SCALE = 20.0, 50.0
PATTERNS = 4


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself, then its beginnings."""
    names = ["=" + word, *("^" + word[:k] for k in STEMS if len(word) >= k)]
    return [xxhash.xxh32_intdigest(n) & (1 << HASH_BITS) - 1 for n in names]


def patterns(text: str, words: list[str]) -> list[int]:
    """Votes of the patterns: insults, symbol noise, shouting, one word again and again."""
    n = max(len(words), 1)
    letters = max(sum(map(len, words)), 1)
    symbols = len(text) - sum(map(len, text.split())) + letters
    upper = sum(map(str.isupper, text))
    insults = sum(map(words.count, INSULTS)) if n < 1000 else sum(w in _INSULTS for w in words)
    return [int(insults >= max(1, SHARE * n)), int(len(text) - symbols > letters / 5), int(upper > letters / 3),
            int(n >= 10 and len(set(words)) < n / 5)]


_INSULTS = frozenset(INSULTS)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> pa.Table:
    """(toxic, n, ids, counts, votes, group) of the sampled rows: one Arrow table of bounded size."""
    key = F.col(f"`{id_col}`")
    chosen = (labels.filter(F.col("toxic").isNotNull() & key.isNotNull() & ~held_out(key))
              .groupBy(key.alias("key")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("key"), "key").limit(sample))
    rows = docs.select(key.alias("key"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                words = WORD.findall(text.lower())
                every = [f for w in words for f in features(w)]
                ids, counts = np.unique(np.array(every, np.int64), return_counts=True)
                sets = np.array([_mixed(ids, s).min() if len(ids) else 0 for s in (1, 2, 3)], np.uint64)
                out.append((toxic, len(words), ids.astype(np.int32).tolist(), counts.astype(np.int32).tolist(),
                            patterns(text, words), xxhash.xxh64_intdigest(sets.tobytes()) >> 1))
            cols = zip(*out) if out else [[]] * 6
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["toxic", "n", "ids", "counts", "votes", "same"])

    # At most ``sample`` ids and labels: broadcast by that bound.
    return (rows.join(F.broadcast(chosen), "key").select("toxic", "text")
            .mapInArrow(run, "toxic int, n int, ids array<int>, counts array<int>, votes array<int>, same bigint")
            .toArrow())


def _mixed(ids: np.ndarray, seed: int) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


# --- the label model ------------------------------------------------------

class LabelModel:
    """Tree-augmented naive Bayes over binary votes, fitted without labels."""

    def fit(self, votes: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
        """``votes`` (texts x voters, 0 or 1); returns the posterior of class 1."""
        n, m = votes.shape
        fired = votes.sum(axis=1)
        post = np.where(fired >= 2, 0.9, np.where(fired == 1, 0.5, 0.02))
        self.parent = np.full(m, -1)
        for turn in range(rounds):
            self.prior = float(np.clip((post * weight).sum() / max(weight.sum(), 1e-9), 1e-4, 0.5))
            if turn in (3, 10):
                self.parent = self.tree(votes, post, weight)
            self.rates = self.conditionals(votes, post, weight)
            new = self.posterior(votes)
            if np.abs(new - post).max() < 1e-6 and turn > 10:
                break
            post = new
        # Class 1 is the one in which voters fire more.
        return post

    def conditionals(self, votes, post, weight) -> np.ndarray:
        """P(vote = 1 | class, parent's vote) as [voter, class, parent's vote]."""
        out = np.empty((votes.shape[1], 2, 2))
        for j, p in enumerate(self.parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            for c in (0, 1):
                w = weight * (post if c else 1 - post)
                base = (w @ votes[:, j] + (0.5 if c else 0.05)) / (w.sum() + 1)
                for a in (0, 1):
                    wa = w * (above == a)
                    out[j, c, a] = (wa @ votes[:, j] + 2 * base) / (wa.sum() + 2)
        return np.clip(out, 1e-4, 1 - 1e-4)

    def tree(self, votes, post, weight) -> np.ndarray:
        """Parents in the maximum spanning tree of the voters' mutual information given the class."""
        m = votes.shape[1]
        info = np.zeros((m, m))
        total = weight.sum()
        for c in (0, 1):
            w = weight * (post if c else 1 - post)
            s = max(w.sum(), 1e-9)
            one = (w @ votes) / s
            both = (votes * w[:, None]).T @ votes / s
            for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)):
                pa_, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None]
                joint = both if a and b else one[:, None] - both if a else one[None] - both if b else 1 - one[:, None] - one[None] + both
                joint = np.maximum(joint, 1e-12)
                info += s / total * joint * np.log(joint / np.maximum(pa_ * pb, 1e-12))
        parent = np.full(m, -1)
        best, link, done = np.full(m, -np.inf), np.full(m, -1), np.zeros(m, bool)
        at = 0
        for _ in range(m):
            done[at] = True
            closer = info[at] > best
            best[closer & ~done], link[closer & ~done] = info[at][closer & ~done], at
            if done.all():
                break
            at = int(np.argmax(np.where(done, -np.inf, best)))
            parent[at] = link[at]
        return parent

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for j, p in enumerate(self.parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            p1, p0 = self.rates[j, 1, above], self.rates[j, 0, above]
            odds += np.where(votes[:, j] == 1, np.log(p1 / p0), np.log((1 - p1) / (1 - p0)))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


# --- fitting --------------------------------------------------------------

def fit(table: pa.Table) -> dict:
    """The classifier: {"bias", "ids", "weights"} from ``training_rows``."""
    n_rows = table.num_rows
    toxic = table["toxic"].to_numpy().astype(int) if n_rows else np.zeros(0, int)
    if not n_rows or not 0 < toxic.sum() < n_rows:
        ids = [features(w)[0] for w in INSULTS]
        return {"bias": -3.0, "ids": np.array(ids), "weights": np.full(len(ids), 6.0)}
    col = lambda name: table[name].combine_chunks()
    lists = col("ids")
    ids, counts = lists.values.to_numpy(), col("counts").values.to_numpy().astype(np.float32)
    row = np.repeat(np.arange(n_rows, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    words = table["n"].to_numpy()
    _, same, size = np.unique(table["same"].to_numpy(), return_inverse=True, return_counts=True)
    weight = 1 / size[same]

    # Lexicons: features that stand out in toxic texts, dealt to voters by rank.
    pos = np.bincount(ids, weight[row] * toxic[row], 1 << HASH_BITS)
    neg = np.bincount(ids, weight[row] * (1 - toxic[row]), 1 << HASH_BITS)
    n1, n0 = weight @ toxic, weight @ (1 - toxic)
    gain = surprise(pos, neg, n1, n0)
    gain[(pos < MIN_TEXTS) | (pos * n0 <= neg * n1)] = 0
    top = np.argsort(-gain, kind="stable")[:2 * ENTRIES]
    top = top[gain[top] > LEAST_GAIN]
    voter = np.full(1 << HASH_BITS, -1)
    voter[top] = np.arange(len(top)) % (2 * LEXICONS)
    hit = voter[ids] >= 0
    hits = np.zeros((n_rows, 2 * LEXICONS))
    np.add.at(hits, (row[hit], voter[ids[hit]]), counts[hit])
    votes = (hits >= np.maximum(1, SHARE * words)[:, None]).astype(int)
    fixed = np.array(table["votes"].to_pylist(), int).reshape(n_rows, PATTERNS)
    votes = np.concatenate([votes, fixed], axis=1)

    target = LabelModel().fit(votes, weight)

    # The classifier, on the features that stand out in either class of posterior labels.
    pos = np.bincount(ids, weight[row] * target[row], 1 << HASH_BITS)
    neg = np.bincount(ids, weight[row] * (1 - target[row]), 1 << HASH_BITS)
    gain = surprise(pos, neg, weight @ target, weight @ (1 - target))
    known = np.flatnonzero(gain > TELLING)
    known = known[np.argsort(-gain[known], kind="stable")[:MAX_WEIGHTS]]
    place = np.full(1 << HASH_BITS, -1)
    place[known] = np.arange(len(known))
    use = place[ids] >= 0
    row, at = row[use], place[ids[use]].astype(np.int32)
    x = (counts[use] * SCALE / (words[row] + PAD)).astype(np.float32)
    del ids, counts, use
    # Both classes weigh the same in total, and near copies share one weight.
    balance = np.where(target > .5, .5 / max((weight * target).sum(), 1e-9), .5 / max((weight * (1 - target)).sum(), 1e-9))
    share = weight * balance / (weight * balance).sum()
    w, bias = np.zeros(len(known)), 0.0
    mw, vw, mb, vb = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
    for t in range(1, 151):  # Adam over the whole sample
        odds = bias + np.bincount(row, x * w[at], n_rows)
        error = share * (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - target)
        gw, gb = np.bincount(at, x * error[row], len(known)) + PENALTY * w, error.sum()
        mw, vw = .9 * mw + .1 * gw, .99 * vw + .01 * gw * gw
        mb, vb = .9 * mb + .1 * gb, .99 * vb + .01 * gb * gb
        a, b = 1 - .9 ** t, 1 - .99 ** t
        w -= .1 * (mw / a) / (np.sqrt(vw / b) + 1e-8)
        bias -= .1 * (mb / a) / (math.sqrt(vb / b) + 1e-8)
    return {"bias": float(bias), "ids": known, "weights": w}


def surprise(pos: np.ndarray, neg: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Log-likelihood ratio statistic of each feature's counts in n1 toxic and n0 other texts."""
    total, n = pos + neg, n1 + n0
    out = np.zeros(len(pos))
    for seen, expected in ((pos, total * n1 / n), (neg, total * n0 / n),
                           (n1 - pos, (n - total) * n1 / n), (n0 - neg, (n - total) * n0 / n)):
        some = (seen > 0) & (expected > 0)
        out[some] += 2 * seen[some] * np.log(seen[some] / expected[some])
    return out


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] | None = None) -> DataFrame:
    """(id, score, text, *carry) for every row of ``docs``; the score is from the whole text alone."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(  # MAX_WEIGHTS weights at most
        (model["bias"], np.asarray(model["ids"], np.int32), np.asarray(model["weights"], np.float32)))
    row = F.struct(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                   *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry or [])])
    rows = docs.select(row.alias("row"))

    def run(batches):
        bias, ids, weights = shared.value
        known = dict(zip(ids.tolist(), weights.tolist()))
        memo: dict[str, float] = {}

        def weigh(word: str) -> float:
            if len(memo) > 150_000:
                memo.clear()
            got = memo[word] = sum([known.get(f, 0.0) for f in features(word)])
            return got

        for batch in batches:
            out = []
            for text in batch.column(0).field("text"):
                words = WORD.findall((text.as_py() or "").lower())
                total = sum([w if (w := memo.get(word)) is not None else weigh(word) for word in words])
                odds = bias + SCALE * total / (len(words) + PAD)
                out.append(1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["row", "score"])

    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return out.select(F.col("row.id").alias(id_col), "score", F.col("row.text").alias(text_col),
                      *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(carry or [])])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE) -> dict:
    return fit(training_rows(docs, labels, id_col, text_col, sample))
