"""SentencePiece encoding by sampled segmentations, and lossless decoding.

A text is cut into chunks where no piece can cross: before each blank (which
becomes the word mark), around newlines, between a letter and most marks.
Over the piece lattice of a chunk, forward filtering gives the total weight of
all segmentations of every prefix; backward sampling then draws one whole
segmentation in proportion to its weight, from the end, piece by piece.  The
forward tables of distinct chunks are computed once and kept (a bounded table),
and the draws of all chunks of a text are made together.  The random numbers
are a hash of the row key, the chunk's place and the draw's number, so a row's
segmentation depends on its key and the seed alone, not on partitions, order
or retries.

The model file holds merge ranks, not probabilities; piece of rank r gets
weight (r + 2) ** -alpha (Zipf's law at alpha = 1; larger values sample fewer,
commoner pieces).  Characters outside the vocabulary, the word mark itself and
control characters become byte pieces, so decoding returns the exact text.

Defined results: a null or empty text has no pieces and decodes to the empty
text; a null key draws like key 0; rows that share a key and text get equal
segmentations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from volspark.llm.common import small, texts_of

MARK = "▁"
LITERAL = "\ud800"
LETTER = r"[^\W\d_]"
SCHEMA = "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, text_sha256 string, lossless boolean"


class Pieces:
    """The vocabulary: text pieces with log weights, and the byte pieces."""

    def __init__(self, model_file: str, alpha: float = 1.0):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.byte_ids = np.full(256, -1, np.int64)
        self.ids: dict[str, int] = {}
        self.weight = np.zeros(n)
        spelling = [b""] * n  # what each piece decodes to
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                spelling[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and MARK not in piece[1:] and "\n" not in piece:
                self.ids[piece] = i
                self.weight[i] = -alpha * np.log(max(0.0, -sp.get_score(i)) + 2)
                spelling[i] = piece.replace(MARK, " ").encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces, so it cannot encode every text")
        self.longest = max(map(len, self.ids))
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte_ids] = True
        self.size = np.array([len(x) for x in spelling], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelling), np.uint8)
        # hashes of all beginnings of pieces, by length, each with its piece
        # (or -1), for lookups of many substrings at once
        self.starts: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int32))]
        for k in range(1, self.longest + 1):
            own = sorted({x[:k] for x in self.ids if len(x) >= k})
            h = roll(np.array([[ord(c) for c in x] for x in own], np.uint64))
            at = np.argsort(h)
            self.starts.append((h[at], np.array([self.ids.get(x, -1) for x in own], np.int32)[at]))

        # no piece holds a newline, a blank within, or a letter followed by one
        # of these marks: cutting there leaves the lattice as it is
        within = {b for x in self.ids for a, b in zip(x, x[1:]) if re.match(LETTER, a)}
        marks = "".join(re.escape(c) for c in string.punctuation if c not in within)
        before_mark = f"{MARK}?{LETTER}++(?=[{marks}])|" if marks else ""
        self.chunk = re.compile(f"\n|{before_mark}{MARK}[^{MARK}\n]*|[^{MARK}\n]+")

    def chunks_of(self, text: str) -> list[str]:
        """The text cut before each blank, around newlines and between a letter
        and a mark.  Blanks are word marks; a literal word mark is a lone
        surrogate, which neither texts nor pieces hold."""
        return self.chunk.findall(text.replace(MARK, LITERAL).replace(" ", MARK))

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of a piece sequence."""
        n = self.size[ids]
        return self.bytes[np.repeat(self.first[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes()


STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A string's hash with one more character."""
    with np.errstate(over="ignore"):
        h = (h ^ (c + np.uint64(1))) * STEP
    return h ^ (h >> np.uint64(29))


def roll(chars: np.ndarray) -> np.ndarray:
    h = np.zeros(len(chars), np.uint64)
    for j in range(chars.shape[1]):
        h = mix(h, chars[:, j])
    return h


class Lattices:
    """Backward-sampling tables of distinct chunks.

    A state is an end position in a chunk; states are numbered chunk by chunk.
    Its choices (pieces that end there) are entries ``first[s]:first[s + 1]``
    of ``cum`` (cumulative probability), ``piece`` (below 0: a character to be
    spelled in bytes) and ``length`` (characters, so the state to go on from)."""

    def __init__(self, pieces: Pieces, most: int = 16_000_000):
        self.pieces, self.most = pieces, most
        self.clear()

    def clear(self) -> None:
        self.last: dict[str, int] = {}  # chunk -> state of its end
        self.size: list[np.ndarray] = []
        self.first, self.begin = array("q", [0]), array("q")
        self.cum, self.piece, self.length = array("d"), array("i"), array("i")

    def add(self, chunks: list[str]) -> None:
        """Forward filtering of many chunks side by side."""
        p = self.pieces
        size = np.array([len(c) for c in chunks], np.int64)
        chars = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        start = np.cumsum(size) - size
        inside = np.arange(len(chars)) - np.repeat(start, size)  # characters before this one in its chunk
        left = np.repeat(size, size) - inside
        # (last character, length, piece) of every piece in every chunk
        at, h = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        ends, lengths, ids = [], [], []
        for k in range(1, p.longest + 1):
            h = mix(h, chars[at + k - 1])
            hashes, own = p.starts[k]
            pos = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            alive = hashes[pos] == h
            at, h, piece = at[alive], h[alive], own[pos[alive]]
            whole = piece >= 0
            ends.append(at[whole] + k - 1), ids.append(piece[whole]), lengths.append(np.full(len(ends[-1]), k, np.int32))
            more = left[at] > k
            at, h = at[more], h[more]
            if not len(at):
                break
        # a character at which no piece ends is spelled in bytes
        single = np.ones(len(chars), bool)
        single[np.concatenate(ends)] = False
        single = np.flatnonzero(single)
        ends.append(single), lengths.append(np.ones(len(single), np.int32)), ids.append(-1 - chars[single].astype(np.int32))
        e, n, i = np.concatenate(ends), np.concatenate(lengths), np.concatenate(ids)
        at = np.argsort(e, kind="stable")
        e, n, i = e[at], n[at], i[at]
        weight = np.where(i >= 0, p.weight[np.maximum(i, 0)], -30.0)
        # total[1 + e]: log weight of all segmentations up to and with
        # character e; step by step over the places in the chunks
        total = np.zeros(len(chars) + 1)
        first = np.searchsorted(e, np.arange(len(chars) + 1))
        by_place = np.argsort(inside[e], kind="stable")
        cuts = np.searchsorted(inside[e][by_place], np.arange(int(size.max()) + 1))
        reach = np.empty(len(e))
        for step in range(int(size.max())):
            j = by_place[cuts[step] : cuts[step + 1]]
            r = weight[j] + np.where(n[j] <= step, total[1 + e[j] - n[j]], 0.0)
            head = np.flatnonzero(np.r_[True, e[j][1:] != e[j][:-1]])
            top = np.repeat(np.maximum.reduceat(r, head), np.diff(np.r_[head, len(j)]))
            x = np.exp(r - top)
            total[1 + e[j][head]] = top[head] + np.log(np.add.reduceat(x, head))
            reach[j] = r
        chance = np.exp(reach - total[1 + e])
        cum = np.cumsum(chance)
        cum -= np.repeat(np.concatenate([[0.0], cum])[first[:-1]], np.diff(first))
        done, states = len(self.cum), len(self.first) - 1
        self.cum.frombytes(cum.tobytes())
        self.piece.frombytes(i.astype(np.int32).tobytes())
        self.length.frombytes(n.tobytes())
        self.first.frombytes((done + first[1:]).astype(np.int64).tobytes())
        self.begin.frombytes((states + np.repeat(start, size)).astype(np.int64).tobytes())
        for c, end in zip(chunks, (states + start + size - 1).tolist()):
            self.last[c] = end

    def ends(self, chunks: list[str]) -> np.ndarray:
        """End states of the chunks, in order."""
        at = list(map(self.last.get, chunks))
        if None in at:
            missing = {c for c, i in zip(chunks, at) if i is None}
            if len(self.cum) > self.most:
                self.clear()
                missing = set(chunks)
            missing = sorted(missing, key=lambda c: (len(c), c))  # like lengths side by side
            for i in range(0, len(missing), 20_000):
                self.add(missing[i : i + 20_000])
            at = list(map(self.last.__getitem__, chunks))
        return np.array(at, np.int64)


def uniforms(keys: np.ndarray, place: np.ndarray, draw: int) -> np.ndarray:
    """Numbers in [0, 1) from a mixing hash of (key, place, draw)."""
    with np.errstate(over="ignore"):
        z = keys + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(draw * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Sampler:
    def __init__(self, model_file: str, alpha: float = 1.0):
        self.pieces = Pieces(model_file, alpha)
        self.lattices = Lattices(self.pieces)

    def encode(self, texts: list[str], keys: list[int], seed: int = 0, together: int = 1_000_000):
        """Piece ids of one sampled segmentation of each whole text, in order;
        texts are worked on side by side up to ``together`` characters."""
        lo = 0
        while lo < len(texts):
            hi, chars = lo + 1, len(texts[lo])
            while hi < len(texts) and chars + len(texts[hi]) <= together:
                chars += len(texts[hi])
                hi += 1
            yield from self._some(texts[lo:hi], keys[lo:hi], seed)
            lo = hi

    def _some(self, texts, keys, seed):
        parts = [self.pieces.chunks_of(t) if t else [] for t in texts]
        count = np.array([len(x) for x in parts], np.int64)
        chunks = [c for x in parts for c in x]
        if not chunks:
            yield from (np.zeros(0, np.int64) for _ in texts)
            return
        t = self.lattices
        state = t.ends(chunks)
        first, begin = np.frombuffer(t.first, np.int64), np.frombuffer(t.begin, np.int64)
        cum, piece, length = np.frombuffer(t.cum, np.float64), np.frombuffer(t.piece, np.int32), np.frombuffer(t.length, np.int32)
        key = np.repeat(np.array([(k * 0xBF58476D1CE4E5B9 + seed * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64), count)
        place = np.arange(len(chunks)) - np.repeat(np.cumsum(count) - count, count)
        where, drawn, draw = np.arange(len(chunks)), [], 0
        while len(where):
            u = uniforms(key[where], place[where], draw)
            at, end = first[state], first[state + 1] - 1
            go = np.flatnonzero((cum[at] <= u) & (at < end))
            while len(go):
                at[go] += 1
                go = go[(cum[at[go]] <= u[go]) & (at[go] < end[go])]
            drawn.append((where, piece[at]))
            back = state - length[at]
            more = back >= begin[state]
            where, state, draw = where[more], back[more], draw + 1
        # the last draw of a chunk is its first piece
        pieces_in = np.zeros(len(chunks), np.int64)
        for w, _ in drawn:
            pieces_in[w] += 1
        stop = np.cumsum(pieces_in)
        ids = np.empty(int(stop[-1]), np.int64)
        for turn, (w, i) in enumerate(drawn):
            ids[stop[w] - 1 - turn] = i
        ends = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(count)])]
        for lo, hi in zip(ends[:-1], ends[1:]):
            own = ids[lo:hi]
            yield self._spell(own) if (own < 0).any() else own

    def _spell(self, ids: np.ndarray) -> np.ndarray:
        """Byte pieces in the place of characters (numbers below 0)."""
        odd = np.flatnonzero(ids < 0)
        known = {i: self.pieces.byte_ids[list((MARK if chr(-1 - i) == LITERAL else chr(-1 - i)).encode())] for i in np.unique(ids[odd]).tolist()}
        spelled = [known[i] for i in ids[odd].tolist()]
        times = np.ones(len(ids), np.int64)
        times[odd] = [len(x) for x in spelled]
        out = np.repeat(ids, times)
        out[np.repeat(ids < 0, times)] = np.concatenate(spelled)
        return out


_SAMPLERS: dict[tuple[str, float], Sampler] = {}


def sampler_for(model_file: str, alpha: float) -> Sampler:
    """One sampler per model and Python worker; workers serve many tasks."""
    if (model_file, alpha) not in _SAMPLERS:
        _SAMPLERS[model_file, alpha] = Sampler(model_file, alpha)
    return _SAMPLERS[model_file, alpha]


def encode(docs: DataFrame, model_file: str, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``doc_id, ids`` with one sampled segmentation per row."""

    def run(batches):
        s = sampler_for(model_file, alpha)
        for b in small(batches):
            ids = list(s.encode(b.column("text").to_pylist(), [d or 0 for d in b.column("doc_id").to_pylist()], seed))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str, alpha: float = 1.0) -> DataFrame:
    """``doc_id, text`` of rows of ``doc_id, ids``; null ids are no pieces."""

    def run(batches):
        p = sampler_for(model_file, alpha).pieces
        for b in small(batches):
            texts = [p.decode(np.array(i or [], np.int64)).decode() for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_file: str, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """Per row: the number of pieces and of byte pieces, the CRC-32 of the ids
    (little-endian unsigned 32-bit), the decoded text's SHA-256, and whether
    the decoded text equals the text."""

    def run(batches):
        s = sampler_for(model_file, alpha)
        for b in small(batches):
            n, n_bytes, crc, same, sha = [], [], [], [], []
            raw = b.column("text").cast(pa.binary()).to_pylist()
            for text, ids in zip(raw, s.encode(b.column("text").to_pylist(), [d or 0 for d in b.column("doc_id").to_pylist()], seed)):
                back = s.pieces.decode(ids)
                n.append(len(ids)), n_bytes.append(int(s.pieces.is_byte[ids].sum())), crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                sha.append(hashlib.sha256(back).hexdigest()), same.append(back == text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "n_bytes", "ids_crc32", "text_sha256", "lossless"])

    return texts_of(docs).mapInArrow(run, SCHEMA)
