"""Toxicity by a convolutional text classifier.

A word is the sum of three hashed embeddings (two hashes of the word, so that a chance meeting
of one hash is outvoted by the other, and its first four bytes). Filters of widths 1 to 3 run
over the words, each keeps its largest value in the text, and a logistic layer gives the
score. The network is trained in numpy with AdaGrad on a bounded sample of labelled texts
(``SAMPLE`` per class, chosen by hash; one text of an id, at most ``LETTERS`` characters
together), then its output is fitted to the labels' real rate on labelled texts outside the
training sample (``CALIBRATE`` at most). Every language has its own threshold, the best F1 over
all its labelled texts that did not train, from a histogram of their scores. Training data goes
to the driver as hashed words of the bounded sample; every document is scored inside Spark tasks.

Words are lower-cased runs of letters, digits and non-ASCII characters.

Edge cases: a null or wordless text gets the score of a text without any filter response;
without labelled texts of both classes every score is the share of class 1 (0 without labels);
a label repeated for an id counts once (the larger), and of the texts of a drawn id the one of
least hash trains; a language without labelled texts of both classes has the threshold 0.3; texts
are used whole, in groups of about 2 MB. Repeated rows are scored alike; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import landed, table
from cartloom.llm.tokens import PUNCTUATION, Words, groups, mix64, span_hashes

SLOTS = 1 << 16
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Labelled texts per class that train the network, and that calibrate its output.
SAMPLE = 2500
CALIBRATE = 2500
#: Characters of all texts of one use and class that go to the driver, as hashed words.
LETTERS = 1 << 25
#: Steps of the score histogram that thresholds are found on, and the threshold without labels.
STEPS, DEFAULT_AT = 1000, 0.3
EPOCHS = 8
BATCH = 32
STEP = 0.15


def word_slots(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Three embedding slots of every word, and where each text's words start (with the end)."""
    words = Words(raws, PUNCTUATION)
    first = span_hashes(words.buf, words.starts, np.minimum(words.ends, words.starts + 4))
    h = words.hashes
    slots = np.stack([h & np.uint64(SLOTS - 1), mix64(h + np.uint64(1)) & np.uint64(SLOTS - 1),
                      first >> np.uint64(48)]).astype(np.uint16)
    return slots, words.of


class Network:
    """Embeddings, filters, the logistic layer and the calibration of its output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables = rng.normal(0, 0.02, (3, SLOTS, DIM)).astype(np.float32)
        self.filters = [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.shift, self.scale, self.offset = 0.0, 1.0, 0.0

    def embed(self, slots: np.ndarray) -> np.ndarray:
        x = self.tables[0][slots[0]]
        x += self.tables[1][slots[1]]
        x += self.tables[2][slots[2]]
        return x

    def responses(self, x: np.ndarray, k: int) -> np.ndarray:
        """Responses of the filters of one width at every place (``x`` as one text)."""
        w, f = WIDTHS[k], self.filters[k]
        n = len(x) - w + 1
        y = x[:n] @ f[0]
        for j in range(1, w):
            y += x[j:n + j] @ f[j]
        return y

    def pooled(self, slots: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every text, above its bias, else 0."""
        texts = len(of) - 1
        out = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
        x = self.embed(slots)
        n = np.diff(of)
        for k, w in enumerate(WIDTHS):
            use = np.flatnonzero(n >= w)
            if not len(use):
                continue
            y = self.responses(x, k)
            # Segments: the valid places of a text, then those that reach into the next one.
            cuts = np.stack([of[use], of[use] + n[use] - w + 1], axis=1).reshape(-1)
            cuts = cuts[:-1] if cuts[-1] >= len(y) else cuts
            best = np.maximum.reduceat(y, cuts, axis=0)[::2]
            out[use, k * FILTERS:(k + 1) * FILTERS] = np.maximum(best + self.bias[k], 0)
        return out

    def logits(self, slots: np.ndarray, of: np.ndarray) -> np.ndarray:
        return self.pooled(slots, of).astype(np.float64) @ self.out + self.shift

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for first, end, raws in groups(t and t.lower() for t in texts):
            z = self.logits(*word_slots(raws)) * self.scale + self.offset
            out[first:end] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return out


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Network:
    """Fit on hashed texts (slots, 3 x words) and 0/1 labels."""
    net, rng = Network(seed), np.random.default_rng(seed)
    seen_t = np.full((3, SLOTS), 1e-6, np.float32)  # AdaGrad sums, per embedding row
    seen_f = [np.full_like(f, 1e-6) for f in net.filters]
    seen_b = [np.full_like(b, 1e-6) for b in net.bias]
    seen_o, seen_s = np.full_like(net.out, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            grad_f = [np.zeros_like(f) for f in net.filters]
            grad_b = [np.zeros_like(b) for b in net.bias]
            grad_o, grad_s = np.zeros_like(net.out), 0.0
            rows, row_grads = [], []
            part = order[at:at + BATCH]
            for i in part:
                slots = texts[i]
                x = net.embed(slots)
                pooled, places = np.zeros_like(net.out), [None] * len(WIDTHS)
                for k, w in enumerate(WIDTHS):
                    if len(x) >= w:
                        y = net.responses(x, k)
                        places[k] = np.argmax(y, axis=0)
                        pooled[k * FILTERS:(k + 1) * FILTERS] = np.maximum(
                            y[places[k], np.arange(FILTERS)] + net.bias[k], 0)
                error = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.shift, -30, 30))) - labels[i]
                grad_o += error * pooled
                grad_s += error
                back = error * net.out * (pooled > 0)
                for k, w in enumerate(WIDTHS):
                    if places[k] is None:
                        continue
                    b = back[k * FILTERS:(k + 1) * FILTERS]
                    grad_b[k] += b
                    for j in range(w):
                        at_words = places[k] + j
                        grad_f[k][j] += x[at_words].T * b
                        rows.append(slots[:, at_words])
                        row_grads.append((net.filters[k][j] * b).T)
            size = len(part)
            for k in range(len(WIDTHS)):
                for value, grad, seen in ((net.filters[k], grad_f[k] / size, seen_f[k]),
                                          (net.bias[k], grad_b[k] / size, seen_b[k])):
                    seen += grad * grad
                    value -= STEP * 0.3 * grad / np.sqrt(seen)
            grad_o, grad_s = grad_o / size, grad_s / size
            seen_o += grad_o * grad_o
            seen_s += grad_s * grad_s
            net.out -= STEP * 0.3 * grad_o / np.sqrt(seen_o)
            net.shift -= STEP * 0.3 * grad_s / np.sqrt(seen_s)
            if rows:
                row, grad = np.concatenate(rows, axis=1), np.concatenate(row_grads) / size
                for t in range(3):
                    used, inverse = np.unique(row[t], return_inverse=True)
                    total = np.zeros((len(used), DIM), np.float32)
                    np.add.at(total, inverse, grad)
                    seen_t[t, used] += (total * total).mean(axis=1)
                    net.tables[t, used] -= STEP * total / np.sqrt(seen_t[t, used])[:, None]
    return net


def calibrate(net: Network, z: np.ndarray, labels: np.ndarray) -> None:
    """Fit scale and offset of the logits to the labels (logistic regression, Newton steps,
    lightly held to the network's own scale)."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - labels) * z).sum() + 0.1 * (a - 1), (p - labels).sum() + 0.01 * b])
        h = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    net.scale, net.offset = float(max(a, 1e-3)), float(b)


def best_thresholds(scored: DataFrame) -> DataFrame:
    """``lang, at``: the threshold of the best F1 of every language with both classes, from
    ``lang, score, toxic`` rows. Rows are counted by language and step of the score, pre-aggregated;
    a language is a group of at most ``STEPS`` + 1 rows after that."""
    steps = scored.groupBy("lang", F.floor(F.col("score") * STEPS).alias("step")).agg(
        F.count("*").alias("n"), F.sum(F.col("toxic").cast("long")).alias("hits"))
    above = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang")
    sums = steps.select("lang", "step", F.sum("n").over(above).alias("taken"), F.sum("hits").over(above).alias("found"),
                        F.sum("n").over(whole).alias("n"), F.sum("hits").over(whole).alias("hits"))
    f1 = 2 * F.col("found") / (F.col("taken") + F.col("hits"))
    return (sums.where("hits > 0 AND hits < n").groupBy("lang")
            .agg((F.max_by("step", F.struct(f1, "step")) / STEPS).alias("at")))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Network, DataFrame]:
    """Network from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), and the labels of the
    ids that did not train it (one per id)."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("draw", F.xxhash64("doc_id"))
    # Bounded: SAMPLE rows per class and CALIBRATE more of both, as they come in hash order.
    aside = known.where(F.pmod("draw", F.lit(6)) == 0).orderBy("draw", "doc_id").limit(CALIBRATE)
    rest = known.where(F.pmod("draw", F.lit(6)) != 0)
    picks = aside.withColumn("use", F.lit("calibrate"))
    for value in (0, 1):
        picks = picks.unionByName(rest.where(F.col("toxic") == value).orderBy("draw", "doc_id")
                                  .limit(SAMPLE).withColumn("use", F.lit("train")))

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for _, _, raws in groups(t and t.lower() for t in part["text"]):
                slots, of = word_slots(raws)
                found += [slots[:, a:b].tobytes() for a, b in zip(of[:-1], of[1:], strict=True)]
            yield pd.DataFrame({"doc_id": part["doc_id"], "toxic": part["toxic"], "use": part["use"], "slots": found})

    # One text of a drawn id, so there are no more rows than draws; then as many as fit.
    drawn = docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id")
    one = landed(drawn.groupBy("doc_id", "toxic", "use", "draw").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
                 .select("doc_id", F.col("toxic").cast("int").alias("toxic"), "use", "draw", "t.text"), "toxicity-drawn")
    fill = Window.partitionBy("use", "toxic").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    within = one.select("doc_id", F.sum(F.coalesce(F.length("text"), F.lit(0))).over(fill).alias("letters")).where(F.col("letters") <= LETTERS)
    rows = (one.join(within, "doc_id", "left_semi").select("doc_id", "text", "toxic", "use")
            .mapInPandas(hashed, "doc_id long, toxic int, use string, slots binary").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["slots"]))
    read = lambda r: np.frombuffer(r["slots"], np.uint16).reshape(3, -1)
    fitting = [r for r in rows if r["use"] == "train"]
    y = np.array([r["toxic"] for r in fitting], np.float32)
    if not len(y) or y.min() == y.max():
        net = Network()
        net.out[:] = 0
        net.offset = -500.0 if not y.any() else 500.0
        return net, known.select("doc_id", "toxic")
    net = train([read(r) for r in fitting], y)
    held = [r for r in rows if r["use"] == "calibrate"] or fitting
    z = np.array([net.logits(s, np.array([0, s.shape[1]]))[0] for s in map(read, held)])
    truth = np.array([r["toxic"] for r in held], np.float64)
    calibrate(net, z, truth)
    trained = F.broadcast(picks.where("use = 'train'").select("doc_id"))
    return net, known.join(trained, "doc_id", "left_anti").select("doc_id", "toxic")


def score(net: Network, text: Column) -> Column:
    """Score of a text, 0 to 1."""
    shared = net

    @F.pandas_udf("double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(shared.scores(part.tolist()), dtype="float64")

    return judge(text)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn on labelled rows of three of four folds, score every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4))
    net, others = fit(docs, labels.where(fold != 2))
    scored = landed(docs.select("doc_id", (fold == 2).alias("held_out"), "lang", score(net, F.col("text")).alias("score")), "toxicity-scores")
    by_lang = best_thresholds(scored.join(others, "doc_id")).select(F.col("lang").alias("of_lang"), "at")
    own = F.coalesce("at", F.lit(DEFAULT_AT))
    return scored.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        (F.col("score") >= own).alias("toxic_by_language"))
