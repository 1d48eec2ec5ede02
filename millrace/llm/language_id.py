"""Language identification by nearest centroid over TF-IDF vectors of byte n-grams.

A text is lower-cased, everything but letters becomes blanks, and its byte bigrams and trigrams are
hashed into DIMS dimensions. Document frequencies are counted over all training rows. Several
centroids per language come from spherical k-means on a bounded sample of labelled training rows
(PER_LANGUAGE rows expected for each language, chosen by a hash of doc_id). A text gets the language of
the centroid of highest cosine. It is rejected where that cosine lies below the centroid's own limit, a
share of a low quantile of its sample rows' cosines, or where it has no letter.

Rows: a null text counts as empty. Texts without a letter get `und`, score 0, rejected; so do all texts if
there is nothing to learn from. Equal cosines go to the language first in code-point order. Null languages
are not learned from; a null doc_id hashes as the empty text. Repeated rows give repeated results, an
empty table an empty one; columns are picked by name, others ignored. Texts are handled in groups of
bounded rows, each whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import by_text, mapped, share_of, stored

DIMS = 1 << 13
#: Centroids of each language.
CENTROIDS = 4
#: Labelled rows of each language that the centroids are fitted on, about.
PER_LANGUAGE = 500
#: Share of the language's sample that a centroid has at least.
FEW = 0.02
#: Numbers of n-grams for which limits are set. A text is too far from a language if its cosine lies below the limit for the largest of these that it reaches:
#: APART of the way from the cosine that HIGH of texts of random letters stay under to the one that all but LOW of the language's sample
#: reach, both with as many n-grams. Where the two overlap the limit is FAR times the latter, and shorter texts have none.
LENGTHS = tuple(1 << k for k in range(5, 13))
APART, LOW, HIGH, FAR = 0.1, 0.01, 0.99, 0.1
#: Texts of random letters, and sample rows of a language, that a limit is set by.
NOISE, TRIED = 200, 120
#: Texts that are turned into vectors at a time.
ROWS = 256
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_BLANKED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass
class Model:
    languages: list[str]  # one for each centroid
    idf: np.ndarray
    centroids: np.ndarray  # DIMS x centroids, columns of length 1
    limits: np.ndarray  # centroids x LENGTHS


def counts(texts: list[str | None]) -> np.ndarray:
    """Rows of n-gram counts."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for k, text in enumerate(texts):
        data = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-8").translate(_BLANKED), np.uint8).astype(np.uint32)
        two = data[:-1] << 8 | data[1:]
        two = two[two != 0x2020]
        three = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        three = three[(three & 0xFFFF) != 0x2020]
        for grams, salt in ((two, 0x9E3779B1), (three, 0x85EBCA6B)):
            out[k] += np.bincount((grams * np.uint32(salt)) >> np.uint32(19), minlength=DIMS)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(size > 0, size, 1)


def fit(docs: DataFrame) -> Model:
    """Learn from docs(doc_id, text, lang); rows with a null lang or text are left out."""
    docs = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.ones(DIMS, np.float32), np.zeros((DIMS, 0), np.float32), np.zeros(0, np.float32))
    place = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / (1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, PER_LANGUAGE / n))])[F.col("lang")]
    rows = docs.select("text", "lang", (place < share).alias("picked"))

    def gather(batches):
        """The picked rows' vectors, then one row of document frequencies for the partition."""
        n, seen = 0, np.zeros(DIMS, np.int64)
        for batch in batches:
            texts, langs, picked = (batch.column(k).to_pylist() for k in range(3))
            for k in range(0, len(texts), ROWS):
                part = counts(texts[k : k + ROWS])
                n += len(part)
                seen += (part > 0).sum(axis=0)
                for j in np.flatnonzero(picked[k : k + ROWS]):
                    at = np.flatnonzero(part[j])
                    yield pa.record_batch([pa.array([langs[k + j]], pa.string()), pa.array([at.tolist()], pa.list_(pa.int32())), pa.array([part[j][at].tolist()], pa.list_(pa.float64()))], ["lang", "dims", "counts"])
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array([None], pa.string()), pa.array([[*at.tolist(), -1]], pa.list_(pa.int32())), pa.array([[*seen[at].tolist(), float(n)]], pa.list_(pa.float64()))], ["lang", "dims", "counts"])

    found = mapped(rows, gather, "lang string, dims array<int>, counts array<double>")
    # One row a partition for the frequencies; they are summed by dimension before they leave the executors.
    found = stored(found, "language-sample")
    totals = found.filter("lang IS NULL").select(F.explode(F.arrays_zip("dims", "counts")).alias("x")).groupBy(F.col("x.dims").alias("dim")).agg(F.sum("x.counts").alias("n"))
    df, n = np.zeros(DIMS), 0.0
    for r in totals.collect():
        if r["dim"] < 0:
            n = r["n"]
        else:
            df[r["dim"]] = r["n"]
    idf = (np.log((1 + n) / (1 + df)) + 0.05).astype(np.float32)
    picked = sorted((r["lang"], list(r["dims"]), list(r["counts"])) for r in found.filter("lang IS NOT NULL").collect())
    return centroids(picked, idf)


def _noise(n: int, r: np.random.Generator) -> list[str]:
    """NOISE texts of random letters, of about n n-grams each."""
    out = []
    for _ in range(NOISE):
        letters = r.integers(97, 123, n // 2 + 1).astype(np.uint8)
        letters[np.cumsum(r.integers(3, 11, len(letters)))[: len(letters) // 10] % len(letters)] = 32
        out.append(letters.tobytes().decode())
    return out


def _drawn(rows: np.ndarray, n: int, r: np.random.Generator) -> np.ndarray:
    """n n-grams out of each of rows (counts) that has as many."""
    rows = rows[rows.sum(axis=1) >= n][:TRIED].astype(np.float64)
    shares = rows / rows.sum(axis=1, keepdims=True)
    return np.stack([r.multinomial(n, p) for p in shares]).astype(np.float32) if len(rows) else np.zeros((0, DIMS), np.float32)


def _limits(rows: np.ndarray, own: np.ndarray, noise: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """The limits of a language with sample rows (counts) and centroids own (rows), given unit vectors of random letters for each length."""
    r = np.random.default_rng(7)
    out = []
    for n, far in zip(LENGTHS, noise):
        some = _drawn(rows, n, r)
        if not len(some):
            out.append(out[-1] if out else 0.0)
            continue
        low = np.quantile((_unit(some * idf) @ own.T).max(axis=1), LOW)
        high = np.quantile((far @ own.T).max(axis=1), HIGH)
        out.append(float(high + APART * (low - high) if low > high else FAR * low))
    return np.array(out, np.float32)


def centroids(picked: list[tuple[str, list[int], list[float]]], idf: np.ndarray) -> Model:
    """Spherical k-means within each language."""
    languages, columns, limits = [], [], []
    r = np.random.default_rng(11)
    noise = [_unit(counts(_noise(n, r)) * idf) for n in LENGTHS] if picked else []
    for lang in sorted({p[0] for p in picked}):
        own = [p for p in picked if p[0] == lang]
        raw = np.zeros((len(own), DIMS), np.float32)
        for k, (_, dims, values) in enumerate(own):
            raw[k, dims] = values
        rows = _unit(raw * idf)
        rows = rows[(rows > 0).any(axis=1)]
        if not len(rows):
            continue
        at = rows[np.linspace(0, len(rows) - 1, min(CENTROIDS, len(rows))).astype(int)]
        for _ in range(10):
            near = (rows @ at.T).argmax(axis=1)
            at = _unit(np.stack([rows[near == c].mean(axis=0) if (near == c).any() else at[c] for c in range(len(at))]))
        # A few odd rows make no language.
        share = np.bincount((rows @ at.T).argmax(axis=1), minlength=len(at)) / len(rows)
        at = at[share >= min(FEW, share.max())]
        limit = _limits(raw, at, noise, idf)
        for c in range(len(at)):
            languages.append(lang)
            columns.append(at[c])
            limits.append(limit)
    if not columns:
        return Model([], idf, np.zeros((DIMS, 0), np.float32), np.zeros((0, len(LENGTHS)), np.float32))
    return Model(languages, idf, np.stack(columns, axis=1), np.stack(limits))


def judged(docs: DataFrame, model: Model, columns: list[str], names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """The given columns of docs (text among them or not), then language, cosine and rejection under the given names."""
    place = columns.index("text") if "text" in columns else len(columns)
    shape = docs.select(*columns, F.lit("").alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(False).alias(names[2])).schema

    def work(rows: pa.Table) -> pa.Table:
        texts = rows[place].to_pylist()
        lang, score, out = [], [], []
        for k in range(0, len(texts), ROWS):
            part = texts[k : k + ROWS]
            if model.languages:
                found = counts(part)
                size = found.sum(axis=1)
                cosine = _unit(found * model.idf) @ model.centroids
                best = cosine.argmax(axis=1)
                step = np.searchsorted(LENGTHS, size, side="right") - 1
                limit = np.where(step >= 0, model.limits[best, np.maximum(step, 0)], 0)
                top = np.clip(cosine[np.arange(len(part)), best], 0, 1)
            for j, text in enumerate(part):
                if not model.languages or not text or not _LETTER.search(text):
                    lang.append(UNDETERMINED), score.append(0.0), out.append(True)
                else:
                    lang.append(model.languages[best[j]]), score.append(float(top[j])), out.append(bool(top[j] < limit[j]))
        arrays = [*rows.columns[: len(columns)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())]
        return pa.Table.from_arrays(arrays, names=[f.name for f in shape.fields])

    return by_text(docs, columns if "text" in columns else [*columns, "text"], shape, work)


def predicted(docs: DataFrame, held_out: int = 2, folds: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected; learned from the rows outside the held-out fold."""
    fold = share_of(F.col("doc_id"), folds)
    model = fit(docs.filter(fold != held_out))
    rows = docs.select("doc_id", "text", (fold == held_out).alias("held_out"))
    return judged(rows, model, ["doc_id", "held_out"])


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs that are not rejected, unchanged; learned from all of docs."""
    out = judged(docs, fit(docs), docs.columns, ("__lang", "__cosine", "__rejected"))
    return out.filter(~F.col("__rejected")).drop("__lang", "__cosine", "__rejected")
