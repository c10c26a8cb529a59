"""Language identification by multilingual mixture inference.

Training counts hashed byte trigrams of every labelled training text per
language (each task pre-aggregates, Spark sums).  A document is then seen as
drawn from a mixture of the languages' trigram distributions:
expectation-maximisation estimates its language proportions, and the set of
languages grows, largest proportion first, while the penalised likelihood (BIC;
the log likelihood divided by three, as each byte is in three trigrams) rises.
The label is that language of the set that alone explains the text best (the
halves of a short text may be as good as equal); the score is its proportion.

Defined results: a null text or one without a letter is ``und`` with score 0;
without any learned language every text is ``und``; rows with a null id take
part in training.  More than ``max_languages`` distinct labels raise an error,
since the model, of that many times ``2**bits`` numbers, is sent to every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import small

BITS = 15
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, languages string"


def _letters_table() -> np.ndarray:
    """Byte -> itself if it can be part of a letter, else a blank."""
    t = np.full(256, 32, np.uint32)
    for b in range(256):
        if 97 <= b <= 122 or b >= 128:
            t[b] = b
    return t


LETTER_BYTES = _letters_table()


def trigrams(text: str, bits: int = BITS) -> np.ndarray:
    """Hashed trigrams of the lower-cased UTF-8 bytes, blanks around words."""
    b = LETTER_BYTES[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    keep = (b[1:-1] != 32) | ((b[:-2] != 32) & (b[2:] != 32))
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code[keep] * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def count_by_language(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``lang, gram, n`` over all rows of ``(text, lang)``."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in small(batches):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                if text:
                    if lang not in total:
                        total[lang] = np.zeros(1 << bits, np.int64)
                    total[lang] += np.bincount(trigrams(text, bits), minlength=1 << bits)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "gram", "n"])

    part = docs.filter(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(run, "lang string, gram int, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class MixtureModel:
    def __init__(self, languages: list[str], theta: np.ndarray, steps: int = 12):
        self.languages, self.theta, self.steps = languages, theta, steps  # theta: grams x languages

    @staticmethod
    def fit(counts: DataFrame, bits: int = BITS, smooth: float = 0.1, max_languages: int = 1000) -> "MixtureModel":
        languages = sorted(r.lang for r in counts.select("lang").distinct().limit(max_languages + 1).collect())
        if len(languages) > max_languages:
            raise ValueError(f"more than {max_languages} languages to learn")
        table = np.full((1 << bits, len(languages)), smooth)
        if languages:
            got = counts.toPandas()
            np.add.at(table, (got["gram"].to_numpy(), np.searchsorted(languages, got["lang"].to_numpy().astype(str))), got["n"].to_numpy())
        return MixtureModel(languages, (table / table.sum(axis=0)).astype(np.float64))

    def _em(self, p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
        mix = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(self.steps):
            mix = mix * ((c / (p @ mix)) @ p) / c.sum()
        return mix, float(c @ np.log(p @ mix))

    def proportions(self, text: str | None) -> list[tuple[str, float]]:
        """(language, share) of the selected set, the label first; empty for ``und``."""
        if not self.languages or not has_letter(text):
            return []
        grams = trigrams(text)
        count = np.bincount(grams) if len(grams) else np.zeros(1)
        at = np.flatnonzero(count)
        if not len(at):  # letters outside the table's bytes only
            return [(self.languages[0], 1 / len(self.languages))]
        c, p = count[at].astype(float), self.theta[at]
        n = c.sum()
        order = np.argsort(-self._em(p, c)[0], kind="stable") if p.shape[1] > 1 else np.zeros(1, int)
        best, best_value = None, -np.inf
        for k in range(1, len(order) + 1):
            mix, like = self._em(p[:, order[:k]], c) if k > 1 else (np.ones(1), float(c @ np.log(p[:, order[0]])))
            value = like / 3 - 0.5 * (k - 1) * np.log(n + 1)
            if value <= best_value:
                break
            best, best_value = mix, value
        alone = c @ np.log(p[:, order[: len(best)]])
        by_likelihood = np.argsort(-alone, kind="stable")
        return [(self.languages[order[i]], float(best[i])) for i in by_likelihood]


def identify(docs: DataFrame, model: MixtureModel) -> DataFrame:
    """Rows of ``(doc_id, held_out, text)`` -> doc_id, held_out, lang_pred, score, languages."""

    def run(batches):
        for b in small(batches):
            found = [model.proportions(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    b.column("held_out"),
                    pa.array([f[0][0] if f else "und" for f in found], pa.string()),
                    pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()),
                    pa.array([",".join(f"{lang}:{share:.4f}" for lang, share in sorted(f, key=lambda e: -e[1])) for f in found], pa.string()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCHEMA)
