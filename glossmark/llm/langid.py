"""Language identification that lets a document mix languages: proportions by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.llm.common import keep_only, slices

TABLE_BITS = 16
ORDER = 3
#: The model is fitted on about so many labelled documents of each language at most, picked by a hash of their id.
FIT_DOCS_PER_LANGUAGE = 4000
#: Labels learned, those of most documents: a model holds 512 KB a language.
MOST_LANGUAGES = 400
BLOCK_CHARS = 1 << 20
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def ngram_counts(text: str) -> np.ndarray:
    """How often each hashed byte n-gram occurs in the lower-cased text; what isn't a letter counts as a space, runs as one."""
    total = np.zeros(1 << TABLE_BITS, np.int64)
    for at in range(0, len(text), BLOCK_CHARS):
        raw = np.frombuffer(b" ".join(text[at : at + BLOCK_CHARS + ORDER].lower().encode(errors="replace").translate(_TO_SPACE).split()), np.uint8).astype(np.uint32)
        if len(raw) >= ORDER:
            code = raw[: len(raw) - ORDER + 1].copy()
            for k in range(1, ORDER):
                code = code * np.uint32(257) + raw[k : len(raw) - ORDER + 1 + k]
            total += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS), minlength=1 << TABLE_BITS)
    return total


@dataclass
class LanguageModel:
    """probability[l, g]: of the n-gram g in the language languages[l]."""

    languages: list[str]
    probability: np.ndarray
    #: A further language must raise the log likelihood by so many times log(n-grams).
    penalty: float = 3.0
    rounds: int = 15

    def proportions(self, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """EM over the rows of p; with the log likelihood reached."""
        share = np.full(len(p), 1 / len(p))
        for _ in range(self.rounds):
            part = share[:, None] * p
            part *= n / part.sum(0)
            new = part.sum(1) / n.sum()
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
        return share, float(np.log(share @ p) @ n)

    def mixture(self, text: str | None) -> dict[str, float]:
        """Languages and their proportions, of those that pay for themselves; {} for a text without letters."""
        if not self.languages or text is None or not _LETTER.search(text):
            return {}
        counts = ngram_counts(text)
        grams = np.flatnonzero(counts)
        if not len(grams):
            return {self.languages[0]: 1 / len(self.languages)}
        n, p = counts[grams].astype(float), self.probability[:, grams]
        single = np.log(p) @ n
        chosen = [int(single.argmax())]
        best, share = float(single.max()), np.ones(1)
        if len(self.languages) > 1:
            everything, _ = self.proportions(p, n)
            for other in np.argsort(-everything, kind="stable"):
                if other in chosen:
                    continue
                new, likelihood = self.proportions(p[[*chosen, other]], n)
                if likelihood - best <= self.penalty * np.log(n.sum() + 1):
                    break
                chosen, best, share = [*chosen, int(other)], likelihood, new
        return {self.languages[k]: float(s) for k, s in zip(chosen, share, strict=True)}

    def predict(self, text: str | None) -> tuple[str, float, dict[str, float]]:
        found = self.mixture(text)
        if not found:
            return UNDETERMINED, 0.0, {}
        top = min(found, key=lambda k: (-found[k], k))
        return top, min(1.0, found[top]), found


def unlabelled() -> LanguageModel:
    """For tables without labels: one language of no name that has every text with a letter."""
    return LanguageModel(["unlabelled"], np.full((1, 1 << TABLE_BITS), 1 / (1 << TABLE_BITS)))


def held_out(id_: Column) -> Column:
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = FIT_DOCS_PER_LANGUAGE, languages: int = MOST_LANGUAGES) -> LanguageModel:
    """A model from the labelled documents outside the held-out fold.

    At most about per_language documents of each language are read whole, picked by a hash of their id; null labels, texts
    and ids are left out, and so are labels beyond the most frequent ones, as a dirty column may hold any number. What comes to the driver is a table of languages by 65,536 hashed n-grams, whatever the input."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    counted = known.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n__")).orderBy(F.desc("n__"), lang_col)
    sizes = {r[0]: r[1] for r in counted.limit(languages).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((0, 1 << TABLE_BITS)))
    limit = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, per_language / sizes[k])))])
    sample = known.where(F.col(lang_col).isin(languages)).where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < limit[F.col(lang_col)] * (1 << 20)).select(lang_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[lang] = sums.get(lang, 0) + ngram_counts(text)
        for lang, total in sums.items():
            grams = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.astype(np.int32)), pa.array(total[grams])], names=["lang", "gram", "n"])

    table = sample.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(languages), 1 << TABLE_BITS), 0.5)
    rows = np.searchsorted(languages, table.column("lang").to_pylist()) if table.num_rows else []
    counts[rows, table.column("gram").to_numpy()] += table.column("n").to_numpy()
    return LanguageModel(languages, counts / counts.sum(1, keepdims=True))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score (its proportion, 0 to 1) and mixture (all proportions).

    A text that is null or without a letter gets `und`, 0 and an empty mixture, as does each text if the model knows no
    language. Ties go to the language that sorts first. Only the text is read; columns named like the added ones are replaced."""

    @F.arrow_udf("struct<lang_pred: string, score: double, mixture: map<string, double>>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keep_only()
        for some in slices(pa.RecordBatch.from_arrays([texts], names=["text"]) for texts in batches):
            found = [model.predict(t) for t in some.column("text").to_pylist()]
            fields = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([list(x[2].items()) for x in found], pa.map_(pa.string(), pa.float64()))]
            yield pa.StructArray.from_arrays(fields, names=["lang_pred", "score", "mixture"])

    keep = [c for c in docs.columns if c.lower() not in {"lang_pred", "score", "mixture"}]
    found = docs.select(*keep, predict(F.col(text_col)).alias("found__"))
    return found.select(*keep, "found__.lang_pred", "found__.score", "found__.mixture")
