"""Language identification by nearest centroids.

A text becomes a vector of hashed character 1- to 3-grams (``DIMS`` slots), weighted by
log(1 + count) times the inverse document frequency and normalised. Every language has up to
``CLUSTERS`` centroids, found by spherical k-means on a bounded sample of its labelled texts.
The nearest centroid by cosine names the language; a text that is farther from it than the
language's calibrated distance is rejected.

Document frequencies are counted over all training texts. The sample (``SAMPLE`` different texts
per language, those of the smallest hashes) only fits centroids; it is a stated bound. Copies
of a text count once, so no group of copies hides or fills a language.

The rejection distances come from all different labelled texts. Every text gives its cosine to
the centroids of its language at its own length class, and a piece out of its middle that of a
shorter class chosen by its hash. Texts of the sample are compared with centroids fitted
without them (``CROSS`` folds). A language with fewer than ``FEW`` cosines of a class takes
those of all languages, a class with fewer altogether those of all classes.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and rejected; a
null language trains nothing; without any training text everything is ``und``. Texts are
used whole, long ones in pieces. Repeated rows are judged alike; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import table

DIMS = 1 << 12
CLUSTERS = 3
#: Different labelled texts per language that fit centroids.
SAMPLE = 256
#: A text is rejected below this share of the cosine that all but 1 % of the labelled texts
#: reach at the text's own length class.
REJECT = 0.5
#: Fewest cosines that a language's or a length class's own distance is taken from.
FEW = 20
#: Folds of the sample that are compared with the centroids of the others; steps of a cosine.
CROSS, STEPS = 4, 1000
PIECE = 1 << 18
_MUL = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_SHIFT = np.uint32(20)  # leaves log2(DIMS) bits


_ASCII_LETTER = np.array([chr(c).isalpha() for c in range(128)])


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; every run of other characters than letters (ASCII,
    Latin-1 signs, general punctuation and symbols) becomes one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = ((codes >= 0xC0) & ((codes < 0x2000) | (codes >= 0x2C00))
              | _ASCII_LETTER[np.minimum(codes, 127)] & (codes < 128))
    before = np.concatenate(([False], inside[:-1]))
    return np.where(inside, codes, np.uint32(0x20))[inside | before]


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of the text's letters."""
    codes = letters(text)
    counts = np.zeros(DIMS, np.float32)
    for at in range(0, len(codes), PIECE):
        c = codes[max(0, at - 2):at + PIECE]
        new = min(at, 2)  # the first characters only give context
        one = c * _MUL[0]
        two = (one[:-1] ^ np.uint32(0x51)) * _MUL[1] + c[1:]
        three = (two[:-1] ^ np.uint32(0x2F)) * _MUL[2] + c[2:]
        slots = [one[new:] * _MUL[2] >> _SHIFT, two[max(0, new - 1):] * _MUL[0] >> _SHIFT,
                 three * _MUL[0] >> _SHIFT]
        counts += np.bincount(np.concatenate(slots), minlength=DIMS).astype(np.float32)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    out = np.stack([gram_counts(t) for t in texts])
    np.log1p(out, out=out)
    out *= idf
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    return out


def length_class(text: str) -> int:
    """Doubling classes of the number of characters."""
    return min(15, len(text).bit_length())


def trials(x: np.ndarray, texts: list[str], draws: list[int], idf: np.ndarray,
           centroids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``draw, class, step`` of the best cosine of every text (rows of ``x``) and of a shorter
    piece out of its middle."""
    def steps(rows: np.ndarray) -> list[int]:
        best = np.max(rows @ centroids.T, axis=1)
        return np.clip(np.floor(best * STEPS), 0, STEPS).astype(int).tolist()

    for text, draw, step in zip(texts, draws, steps(x), strict=True):
        yield draw, length_class(text), step
    cut = []
    for text, draw in zip(texts, draws, strict=True):
        k = draw % max(1, length_class(text) - 1)
        piece = text[len(text) // 2:][:1 << k]
        if has_letter(piece):
            cut.append((draw, piece))
    if cut:
        for (draw, piece), step in zip(cut, steps(vectors([t for _, t in cut], idf)), strict=True):
            yield draw, length_class(piece), step


def quantile(counts: np.ndarray, share: float = 0.01) -> float:
    """Cosine that all but ``share`` of the counted steps reach."""
    return int(np.searchsorted(np.cumsum(counts), share * counts.sum(), side="right")) / STEPS


def least_cosines(counts: np.ndarray) -> np.ndarray:
    """Bounds by language and length class from counts by language, class and step."""
    langs = len(counts)
    every, whole = counts.sum(axis=0), counts.sum(axis=(0, 1))
    least = np.zeros((langs, 16))
    for i in range(langs):
        for k in range(16):
            own = next((c for c in (counts[i, k], every[k], whole) if c.sum() >= FEW), whole)
            least[i, k] = REJECT * quantile(own) if own.sum() else 0.0
    return least


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the text nearest to the mean, then the farthest ones."""
    centers = [x[np.argmax(x @ x.mean(0))]]
    for _ in range(min(k, len(x)) - 1):
        centers.append(x[np.argmin(np.max(x @ np.stack(centers).T, axis=1))])
    c = np.stack(centers)
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].sum(0)
                c[j] /= max(np.linalg.norm(c[j]), 1e-12)
    return c


class Model:
    """Centroids with their languages, and the least cosine by language and length class."""

    def __init__(self, langs: list[str], centroids: np.ndarray, of: np.ndarray,
                 least: np.ndarray, idf: np.ndarray):
        self.langs, self.centroids, self.of, self.least, self.idf = langs, centroids, of, least, idf

    def predict(self, texts: list[str | None]) -> tuple[list, list, list]:
        """Languages, cosines and rejections."""
        langs, scores, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        use = [i for i, t in enumerate(texts) if has_letter(t)] if self.langs else []
        for at in range(0, len(use), 256):
            part = use[at:at + 256]
            cosines = vectors([texts[i] for i in part], self.idf) @ self.centroids.T
            best = np.argmax(cosines, axis=1)
            for i, b, s in zip(part, best, cosines[np.arange(len(part)), best], strict=True):
                lang = self.of[b]
                langs[i] = self.langs[lang]
                scores[i] = float(min(1.0, max(0.0, s)))
                rejected[i] = bool(s < self.least[lang, length_class(texts[i])])
        return langs, scores, rejected


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Fit on the labelled rows of ``docs``."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, langs = np.zeros(DIMS, np.int64), {}
        for part in parts:
            for text, lang in zip(part["text"], part["lang"], strict=True):
                if has_letter(text):
                    df += gram_counts(text) > 0
                    langs[lang] = langs.get(lang, 0) + 1
        held = np.flatnonzero(df)
        yield pd.DataFrame({"lang": pd.Series([None] * len(held) + list(langs), dtype=object),
                            "dim": [*held.tolist(), *[-1] * len(langs)],
                            "n": [*df[held].tolist(), *langs.values()]})

    counted = (rows.mapInPandas(frequencies, "lang string, dim int, n long")
               .groupBy("lang", "dim").agg(F.sum("n").alias("n")).collect())
    sizes = {r["lang"]: r["n"] for r in counted if r["dim"] < 0}
    n = sum(sizes.values())
    df = np.zeros(DIMS)
    for r in counted:
        if r["dim"] >= 0:
            df[r["dim"]] = r["n"]
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.1)
    if not sizes:
        return Model([], np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros((0, 16)), idf)
    # The sample: first a hash threshold per language, then an exact bound, over different texts.
    # Characters that Java does not know may be letters to Python.
    rows = rows.where(F.col("text").rlike(r"[\p{L}\p{Cn}]")).withColumn(
        "draw", F.shiftrightunsigned(F.xxhash64("text", F.lit(1)), 11))
    different = {r["lang"]: r["m"] for r in
                 rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("m")).collect()}
    share = F.create_map(*[F.lit(x) for s in sizes for x in (s, min(1.0, 2.0 * SAMPLE / max(1, different.get(s, 1))))])
    near = (rows.where(F.col("draw") / F.lit(float(1 << 53)) <= F.try_element_at(share, F.col("lang")))
            .dropDuplicates(["lang", "text"])
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text")))
            .where(F.col("rank") <= SAMPLE).select("lang", "text", "draw"))

    def fit_language(part: pd.DataFrame) -> pd.DataFrame:
        held = [(t, d) for t, d in zip(part["text"], part["draw"], strict=True) if has_letter(t)]
        if not held:
            return pd.DataFrame({"lang": [], "centroids": [], "tried": [], "last": []})
        texts, draws = [t for t, _ in held], [int(d) for _, d in held]
        x = vectors(texts, idf)
        folds, tried = np.arange(len(texts)) % CROSS, []
        for f in range(min(CROSS, len(texts)) if len(texts) > 1 else 0):
            out = np.flatnonzero(folds == f)
            tried += trials(x[out], [texts[i] for i in out], [draws[i] for i in out], idf,
                            k_means(x[folds != f], CLUSTERS))
        return pd.DataFrame({"lang": [part["lang"].iloc[0]],
                             "centroids": [k_means(x, CLUSTERS).astype(np.float32).tobytes()],
                             "tried": [np.array([t[1:] for t in tried], np.int64).tobytes()],
                             "last": [int(part["draw"].max())]})

    fitted = (near.groupBy("lang").applyInPandas(
        fit_language, "lang string, centroids binary, tried binary, last long").collect())
    fitted = sorted(fitted, key=lambda r: r["lang"])
    langs = {r["lang"]: i for i, r in enumerate(fitted)}
    if not langs:
        return Model([], np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros((0, 16)), idf)
    cs = [np.frombuffer(r["centroids"], np.float32).reshape(-1, DIMS) for r in fitted]
    counts = np.zeros((len(langs), 16, STEPS + 1), np.int64)
    for i, r in enumerate(fitted):
        for k, step in np.frombuffer(r["tried"], np.int64).reshape(-1, 2):
            counts[i, k, step] += 1

    def try_rest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for lang, of in part.groupby("lang"):
                held = [(t, int(d)) for t, d in zip(of["text"], of["draw"], strict=True) if has_letter(t)]
                for at in range(0, len(held), 256):
                    texts, draws = zip(*held[at:at + 256], strict=True)
                    out += [(lang, *t) for t in trials(vectors(list(texts), idf), list(texts), list(draws), idf,
                                                       cs[langs[lang]])]
            yield pd.DataFrame(out, columns=["lang", "draw", "k", "step"])

    # The sample holds all texts up to its last draw.
    last = F.create_map(*[F.lit(x) for r in fitted for x in (r["lang"], r["last"])])
    rest = rows.where(F.col("draw") > F.try_element_at(last, F.col("lang"))).select("lang", "text", "draw")
    tried = (rest.mapInPandas(try_rest, "lang string, draw long, k int, step int").distinct()
             .groupBy("lang", "k", "step").agg(F.count(F.lit(1)).alias("n")).collect())
    for r in tried:
        counts[langs[r["lang"]], r["k"], r["step"]] += r["n"]
    return Model(list(langs), np.concatenate(cs),
                 np.repeat(np.arange(len(cs)), [len(c) for c in cs]), least_cosines(counts), idf)


def classify(model: Model, text: Column) -> Column:
    """Struct ``lang, score, rejected`` of a text."""
    shared = model

    @F.pandas_udf("lang string, score double, rejected boolean")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            langs, scores, rejected = shared.predict(part.tolist())
            yield pd.DataFrame({"lang": langs, "score": scores, "rejected": rejected})

    return judge(text)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn on four of five folds, predict every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5))
    model = fit(docs.where(fold != 0))
    judged = docs.select("doc_id", (fold == 0).alias("held_out"), classify(model, F.col("text")).alias("p"))
    return judged.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                         F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))
