"""Byte-level BPE of whole corpora: batched numpy merge rounds.

Texts of a slice are laid end to end. Word starts come from character classes, in array
operations that give what the vocabulary's split pattern gives. Words are cut further between
bytes that stand side by side in no entry of the vocabulary: no merge can cross such a place.
Equal pieces are then merged once: all distinct pieces of a slice lie in one flat array of
symbols; each round looks up all neighbouring pairs by binary search over the sorted pair keys
and merges every piece's lowest-ranked pair, left to right.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCAB = "/opt/tokenizers/byte_bpe_50k.json"
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_NEVER = np.iinfo(np.int32).max


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other, by the Unicode version of the tokenizer library."""
    import tokenizers
    from tokenizers import pre_tokenizers

    # planes 4 and up hold no letters, numbers or white space
    points = np.array([c for c in range(0x40000) if not 0xD800 <= c < 0xE000], np.int64)
    out = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, points))
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
        # behaviour "removed" leaves the stretches between the matches
        gaps = pre_tokenizers.Split(tokenizers.Regex(pattern), "removed").pre_tokenize_str(everything)
        hit = np.ones(len(points), bool)
        for _, (a, b) in gaps:
            hit[a:b] = False
        out[points[hit]] = kind
    return out


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself if printable in Latin-1, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder for a byte-level BPE vocabulary file in JSON (``model.vocab`` and ``model.merges``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, sym = model["vocab"], _byte_symbols()
        self.byte_id = np.zeros(256, np.int32)
        for ch, b in sym.items():
            self.byte_id[b] = vocab[ch]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)[order]
        beside = np.zeros((256, 256), bool)
        for a, b in pairs:
            raw = [sym[c] for c in a + b]
            beside[raw[:-1], raw[1:]] = True
        self.beside = beside.ravel()
        self.classes = _classes()

    def _word_starts(self, cp: np.ndarray, text_start: np.ndarray) -> np.ndarray:
        """Mask of code points at which a word begins."""
        kind = self.classes[cp]
        run = text_start.copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        at = np.flatnonzero(run & ~text_start & (kind != _SPACE))
        after_space = at[kind[at - 1] == _SPACE]
        start[after_space - 1] = True  # the last white space before a word stands alone or joins it
        start[at[cp[at - 1] == 0x20]] = False
        n = len(cp)
        # an apostrophe by itself, not joined to a space, takes s, t, m, d, re, ve or ll with it
        q = np.flatnonzero(run & (cp == 0x27))
        q = q[(q == 0) | text_start[q] | (cp[np.maximum(q - 1, 0)] != 0x20)]
        q = q[q + 1 < n]
        q = q[~text_start[q + 1]]
        if len(q):
            c1 = cp[q + 1]
            ok2 = (q + 2 < n) & ~text_start[np.minimum(q + 2, n - 1)]
            c2 = np.where(ok2, cp[np.minimum(q + 2, n - 1)], 0)
            one = np.isin(c1, [ord(c) for c in "stmd"])
            two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
            hit = one | two
            start[q[hit] + 1] = False
            to = q[hit] + np.where(one[hit], 2, 3)
            to = to[to < n]
            start[to[~text_start[to] & (kind[to] == _LETTER)]] = True
        return start

    def _merge(self, sym: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces that lie end to end in ``sym``; gives all their ids end to end, and counts."""
        n = len(length)
        counts = np.zeros(n, np.int64)
        done_ids, done_piece = [], []
        piece = np.repeat(np.arange(n, dtype=np.int32), length)
        while len(sym):
            inside = piece[1:] == piece[:-1]
            key = (sym[:-1].astype(np.int64) << 32) | sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            rank = np.where(inside & (self.keys[at] == key), self.rank[at], _NEVER)
            rank = np.append(rank, _NEVER)
            first = np.flatnonzero(np.append(True, ~inside))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            over = np.repeat(least == _NEVER, size)
            if over.any():
                done_ids.append(sym[over])
                done_piece.append(piece[over])
            take = (rank == np.repeat(least, size)) & (rank != _NEVER)
            # of pairs that overlap (a run of one symbol) every second is taken, from the left
            if len(take) > 1:
                chained = np.flatnonzero(take[1:] & take[:-1]) + 1
                if len(chained):
                    idx = np.arange(len(take))
                    begin = take & ~np.append(False, take[:-1])
                    origin = np.maximum.accumulate(np.where(begin, idx, 0))
                    take &= (idx - origin) % 2 == 0
            won = np.flatnonzero(take)
            sym = sym.copy()
            sym[won] = self.made[at[won]]
            keep = ~over
            keep[won + 1] = False
            sym, piece = sym[keep], piece[keep]
        if not done_ids:
            return np.zeros(0, np.int32), counts
        ids, piece = np.concatenate(done_ids), np.concatenate(done_piece)
        counts = np.bincount(piece, minlength=n)
        return ids[np.argsort(piece, kind="stable")], counts

    def encode(self, raw: np.ndarray, offsets: np.ndarray, ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Encode texts given as UTF-8 bytes end to end and their n + 1 offsets: ids end to end (or None), and counts.

        Bytes that are no UTF-8 stand for U+FFFD, as readers of such text have it.
        """
        n_texts = len(offsets) - 1
        base = offsets[0]
        raw, offsets = raw[base : offsets[-1]], offsets - base
        if not len(raw):
            return np.zeros(0, np.int32) if ids else None, np.zeros(n_texts, np.int64)
        begins = np.unique(offsets[:-1][np.diff(offsets) > 0])
        try:
            if ((raw[begins] & 0xC0) == 0x80).any():
                raise UnicodeDecodeError("utf-8", b"", 0, 0, "a text begins inside a character")
            text = raw.tobytes().decode("utf-8")
        except UnicodeDecodeError:
            return self.encode(*_replaced(raw, offsets), ids)
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)  # byte at which each code point begins
        text_start = np.zeros(len(cp), bool)
        text_start[np.searchsorted(lead, begins)] = True
        cut = np.ones(len(raw), bool)
        cut[1:] = ~self.beside[(raw[:-1].astype(np.int32) << 8) | raw[1:]]
        cut[lead[self._word_starts(cp, text_start)]] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(raw)))
        codes, rep = _factorize(raw, start, length)
        size = length[rep]
        sym = self.byte_id[raw[_spread(start[rep], size)]]
        made, made_count = self._merge(sym, size)
        per_piece = made_count[codes]
        ends = np.cumsum(per_piece)
        upto = np.append(0, ends)[np.searchsorted(start, offsets)]
        counts = np.diff(upto)
        if not ids:
            return None, counts
        made_at = np.append(0, np.cumsum(made_count)[:-1])
        return made[_spread(made_at[codes], per_piece)], counts


    def safe_cuts(self, raw: np.ndarray, size: int) -> list[int]:
        """Places about ``size`` bytes apart where a text can be cut without changing its ids.

        Between a line end and a visible ASCII character, after one such; or between two ideographs whose
        bytes are neighbours in no entry. A text without such a place stays whole.
        """
        n, cuts, at = len(raw), [0], size
        visible = lambda b: (b > 0x20) & (b < 0x7F)
        ideograph = lambda b: (b >= 0xE4) & (b <= 0xE9)
        while at < n:
            j = np.arange(max(at, cuts[-1] + 3), min(n, at + max(size, 4096)))
            line = (raw[j - 1] == 0x0A) & visible(raw[j - 2]) & visible(raw[j])
            glyph = ideograph(raw[j]) & ideograph(raw[j - 3]) & ~self.beside[(raw[j - 1].astype(np.int32) << 8) | raw[j]]
            ok = np.flatnonzero(line | glyph)
            if len(ok):
                cuts.append(int(j[ok[0]]))
                at = cuts[-1] + size
            else:
                at = int(j[-1]) + 1 if len(j) else at + 1
        return [*cuts, n]

    def encode_long(self, raw: np.ndarray, size: int, ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """One long text, a part of about ``size`` bytes at a time."""
        cuts = self.safe_cuts(raw, size)
        got = [self.encode(raw, np.array([a, b]), ids) for a, b in zip(cuts, cuts[1:], strict=False)]
        return np.concatenate([g for g, _ in got]) if ids else None, np.array([sum(int(n[0]) for _, n in got)])


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all ranges start[i] .. start[i] + size[i], one after the other."""
    total = int(size.sum())
    ends = np.cumsum(size)
    return np.arange(total) + np.repeat(start - (ends - size), size)


def _replaced(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with U+FFFD for what is no UTF-8."""
    texts = [raw[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))


def _factorize(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each piece among the distinct ones, and a piece of each code. Exact: equal codes are checked byte by byte."""
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    words = np.ndarray((len(raw) + 9,), "<u8", buffer=padded, strides=(1,))
    mask = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    h = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def mixed(h, w):
        h = (h ^ w) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))

    h = mixed(h, words[start] & mask[np.minimum(length, 8)])
    step, live = 8, np.flatnonzero(length > 8)
    while len(live):
        h[live] = mixed(h[live], words[start[live] + step] & mask[np.minimum(length[live] - step, 8)])
        step += 8
        live = live[length[live] > step]
    codes, _ = pd.factorize(h)
    n = codes.max() + 1
    rep = np.zeros(n, np.int64)
    rep[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    same = (length == length[rep][codes]) & ((words[start] & mask[np.minimum(length, 8)]) == (words[start[rep]] & mask[np.minimum(length[rep], 8)])[codes])
    step, live = 8, np.flatnonzero(same & (length > 8))
    while len(live):
        other = start[rep[codes[live]]]
        m = mask[np.minimum(length[live] - step, 8)]
        bad = (words[start[live] + step] & m) != (words[other + step] & m)
        same[live[bad]] = False
        step += 8
        live = live[~bad & (length[live] > step)]
    if not same.all():  # pieces whose hashes met by chance get codes of their own
        odd = np.flatnonzero(~same)
        fresh: dict[bytes, int] = {}
        for i in odd:
            b = raw[start[i] : start[i] + length[i]].tobytes()
            if b not in fresh:
                fresh[b] = len(rep)
                rep = np.append(rep, i)
            codes[i] = fresh[b]
    return codes, rep


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteBPE:
    return ByteBPE(path)


def _sent(sc, vocab: str) -> str:
    """``vocab``, with the file sent to the executors once."""
    sent = sc.__dict__.setdefault("_tidemark_vocabularies", set())
    if vocab not in sent:
        sc.addFile(vocab)
        sent.add(vocab)
    return vocab


def _slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text; a longer text is a range by itself."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def encode_texts(
    df: DataFrame, *, key: str, text: str, vocab: str = DEFAULT_VOCAB, ids: bool = True, counts: bool = False, keep: tuple[str, ...] = (), slice_bytes: int = 2_000_000
) -> DataFrame:
    """key, ``keep`` columns, and per text ``ids`` (array of int) and/or ``n_tokens``.

    Ids are those of the vocabulary, without special tokens; the strings of special tokens in a
    text are ordinary text. Null and empty texts have an empty list, blank ones the ids of their
    white space. Repeated rows are encoded each; other columns are ignored, whatever their names.

    No shuffle. ``vocab`` is sent to the executors, for those that don't have it where the driver does. A worker holds the arrays of one
    slice of ``slice_bytes`` bytes of text at a time (some 50 bytes for each byte); longer texts are
    cut where no id can change, and stay whole only if they have no such place.
    """
    names = [key, *keep]
    src = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)], F.col(text).alias("t"))
    schema = ", ".join([*(f"k{i} {src.schema[i].dataType.simpleString()}" for i in range(len(names))), *["ids array<int>"] * ids, *["n_tokens bigint"] * counts])

    vocab = _sent(df.sparkSession.sparkContext, vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(vocab if os.path.exists(vocab) else SparkFiles.get(os.path.basename(vocab)))
        for batch in batches:
            col = batch.column(len(names)).cast(pa.large_string())
            if isinstance(col, pa.ChunkedArray):
                col = col.combine_chunks()
            col = col.fill_null("")
            buffers = col.buffers()
            offsets = np.frombuffer(buffers[1], np.int64)[col.offset : col.offset + len(col) + 1]
            raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
            for a, b in _slices(offsets, slice_bytes):
                if b == a + 1 and offsets[b] - offsets[a] > slice_bytes:
                    got, n = enc.encode_long(raw[offsets[a] : offsets[b]], slice_bytes, ids)
                else:
                    got, n = enc.encode(raw, offsets[a : b + 1], ids)
                out = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                if ids:
                    at = np.append(0, np.cumsum(n)).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(at), pa.array(got, pa.int32())))
                if counts:
                    out.append(pa.array(n, pa.int64()))
                yield pa.RecordBatch.from_arrays(out, names=[*(f"k{i}" for i in range(len(names))), *["ids"] * ids, *["n_tokens"] * counts])

    return src.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(names)})
