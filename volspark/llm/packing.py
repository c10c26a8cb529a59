"""Best-fit packing of token sequences by minimum bin slack.

Tokenising is a map over Arrow batches; its result (one small row per piece)
is written once.  Only the histogram of piece lengths -- at most ``capacity``
entries, whatever the corpus -- reaches the driver, where minimum bin slack
fills one bin at a time: the longest length left plus the subset of the other
lengths whose sum, found by a bitset subset-sum recursion, comes nearest to
the capacity.  The combination is removed as many times as the histogram
holds it, so the number of combinations is bounded by the number of lengths
too.  Pieces take the slots of their length by rank; ranks are counted per
(length, salt), so a length that a third of all pieces share is split.

Defined results: a null or empty text is a document of the separator alone;
an id may repeat (each row is packed); null ids stay null.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.llm.common import give_back, numbered, small, texts_of
from volspark.session import cut_lineage

#: ASCII punctuation that, after a letter or digit, begins a token of its own
#: (not the apostrophe, which begins a contraction).
TAIL = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


#: About how many bytes of text are split into words at a time.
BYTES = 2_000_000

#: Lower-case letters of Latin-1: no normalisation, case or splitting to do.
PLAIN = re.compile("[a-zß-öø-ÿ]+")


class _Table(dict):
    """Word -> number; a word that is asked for first is numbered and noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        self.new.append(word)
        return i


class WordEncoder:
    """Ids of whole texts from a tokenizer that drops white space and case, so
    that a text's ids are those of its words in turn; each word is encoded
    once and kept in a table that is emptied when it holds ``max_words``."""

    def __init__(self, path: str, max_words: int = 1_600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        self.bytes_as_text = self._byte_letters()
        self.plain_ascii = self.bytes_as_text is not None and all(self.bytes_as_text[c] == chr(c) for c in range(ord("a"), ord("z") + 1))
        self._clear()

    def _byte_letters(self) -> dict[int, str] | None:
        """How the pre-tokenizer writes lower-case Latin letters, if words of
        them go to the merges as they are (checked on probes); else None."""
        table = {}
        for c in "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ":
            parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)
            if len(parts) != 1:
                return None
            table[ord(c)] = parts[0][0]
        probes = ["a", "the", "naïve", "straße", "façade", "zzyzx", "éêèç", "internationalisation", "ñandú", "ÿþð"]
        same = all([t.id for t in self.tokenizer.model.tokenize(w.translate(table))] == self.tokenizer.encode(w, add_special_tokens=False).ids for w in probes if PLAIN.fullmatch(w))
        return table if same else None

    def _clear(self) -> None:
        self.words = _Table()
        self.flat, self.ends = array("i"), array("q", [0])

    @staticmethod
    def _split(word: bytes) -> tuple[bytes, bytes] | None:
        """Core and trailing punctuation, if the tokenizer splits there too."""
        core = word.rstrip(TAIL)
        if not core or len(core) == len(word):
            return None
        last = core[-1:]
        ends_word = last.isalnum() if last < b"\x80" else core.decode()[-1].lower()[-1].isalpha()
        return (core, word[len(core) :]) if ends_word else None

    def _learn(self) -> None:
        words, first = self.words, len(self.ends) - 1
        parts: list[tuple[int, int] | None] = []
        while len(parts) < len(words.new):  # cores and tails may be new words too
            word = words.new[len(parts)]
            split = self._split(word) if word[-1] in TAIL else None
            parts.append(split and (words[split[0]], words[split[1]]))
        ids: list[list[int] | None] = [None] * len(parts)
        table, merge, others = self.bytes_as_text, self.tokenizer.model.tokenize, []
        for i, (w, p) in enumerate(zip(words.new, parts)):
            if p is None:
                text = w.decode()
                if table is not None and PLAIN.fullmatch(text):
                    ids[i] = [t.id for t in merge(text if text.isascii() and self.plain_ascii else text.translate(table))]
                else:
                    others.append((i, text))
        for (i, _), e in zip(others, self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)):
            ids[i] = e.ids
        for p, own in zip(parts, ids):
            if p is None:
                self.flat.extend(own)
            else:
                for i in p:
                    self.flat.extend(ids[i - first] if i >= first else self.flat[self.ends[i] : self.ends[i + 1]])
            self.ends.append(len(self.flat))
        words.new = []

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Each text's ids and then the separator, id 0.  Words are numbered for
        all texts together, so that each is looked up once."""
        if len(self.words) > self.max_words:
            self._clear()
        whole: dict[int, list[int]] = {}
        words, sizes = [], []
        for i, text in enumerate(texts):
            before = len(words)
            if b"<|" in text:  # perhaps a special token: case and neighbours count
                whole[i] = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            else:
                words += text.lower().split()
            sizes.append(len(words) - before)
        distinct, at = numbered(words)
        distinct = distinct.to_pylist()
        number = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))
        if self.words.new:
            self._learn()
        ends, flat = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, np.int32)
        first, n = ends[number][at], (ends[number + 1] - ends[number])[at]
        done = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(first - done[:-1], n) + np.arange(done[-1])].astype(np.uint32) if len(flat) else np.zeros(0, np.uint32)
        edge = done[np.cumsum([0, *sizes])].tolist()
        return [np.array([*whole[i], 0], np.uint32) if i in whole else np.append(ids[edge[i] : edge[i + 1]], np.uint32(0)) for i in range(len(texts))]


#: One encoder per tokenizer file and Python worker; workers serve many tasks,
#: so its word table is emptied after each.
_ENCODERS: dict[str, WordEncoder] = {}


def encoder_for(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def few(batch: pa.RecordBatch, size: int = BYTES):
    """Ids and texts of the batch, about ``size`` bytes of text at a time."""
    docs, texts, held = [], [], 0
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
        docs.append(doc), texts.append(text)
        held += len(text)
        if held > size:
            yield docs, texts
            docs, texts, held = [], [], 0
    if texts:
        yield docs, texts


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: pieces of at most ``capacity`` ids."""

    def run(batches):
        encoder = encoder_for(tokenizer_path)
        # the word table holds no cycles; the collector would walk all of it again and again
        collecting = gc.isenabled()
        gc.disable()
        try:
            for b in small(batches):
                rows = []
                for docs_of, texts in few(b):
                    for doc, tokens in zip(docs_of, encoder.encode(texts)):
                        for piece, start in enumerate(range(0, len(tokens), capacity)):
                            part = tokens[start : start + capacity]
                            rows.append((doc, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes())))
                cols = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            if collecting:
                gc.enable()
            encoder._clear()
            give_back()

    return texts_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``lengths`` (each at most as often as counted) with the
    largest sum within ``room``: one bitset of reachable sums per length."""
    mask, reach = (1 << (room + 1)) - 1, 1
    history = []
    for size in lengths:
        if size > room:
            continue
        history.append((size, reach))
        left, step = min(counts[size], room // size), 1
        while left > 0:  # copies in powers of two
            take = min(step, left)
            reach |= (reach << (size * take)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for size, before in reversed(history):
        n = 0
        while not before >> total & 1:
            total, n = total - size, n + 1
        if n:
            used[size] = n
    return used


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination of lengths, how many bins of it), until nothing is left."""
    counts = {k: v for k, v in histogram.items() if v}
    out = []
    while counts:
        lengths = sorted(counts, reverse=True)
        seed = lengths[0]
        counts[seed] -= 1
        combo = fullest([x for x in lengths if counts[x]], counts, capacity - seed)
        counts[seed] += 1
        combo[seed] = combo.get(seed, 0) + 1
        bins = min(counts[x] // n for x, n in combo.items())
        out.append((combo, bins))
        for x, n in combo.items():
            counts[x] -= n * bins
            if not counts[x]:
                del counts[x]
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, salts: int = 64) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    pieces = cut_lineage(pieces_of(docs, tokenizer_path, capacity))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    # at most capacity x salts counts, whatever the corpus
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, sequence, filled = [], 0, dict.fromkeys(histogram, 0)
    for combo, bins in minimum_bin_slack(histogram, capacity):
        offset = 0
        for length, times in sorted(combo.items(), reverse=True):
            for _ in range(times):
                slots.append((length, filled[length], filled[length] + bins, sequence, offset))
                filled[length] += bins
                offset += length
        sequence += bins
    slots = spark.createDataFrame(slots, "length long, lo long, hi long, first_sequence long, offset long")
    by_length = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "salt", F.coalesce(F.sum("n").over(by_length), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("in_salt", rank).join(F.broadcast(before), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("in_salt"))
    # slots of a length are consecutive ranges of ranks; each length has a bounded list of them
    ranges = slots.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "first_sequence", "offset"))).alias("ranges"))
    placed = ranked.join(F.broadcast(ranges), "length").withColumn("slot", F.element_at(F.filter("ranges", lambda r: (r["lo"] <= F.col("rank")) & (F.col("rank") < r["hi"])), 1))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("slot.first_sequence") + F.col("rank") - F.col("slot.lo")).alias("sequence_id"), F.col("slot.offset").alias("offset"))
