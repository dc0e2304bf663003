"""Long spans that stand verbatim in more than one text.

Fixed-block anchors. The texts are cut, from their start, into blocks of half the least span, so a
shared span holds a whole block of either text. Blocks are the index; every rolling window of that
length is a probe. A window goes where its least sub-window hash sends it, and neighbouring windows
mostly share that sub-window, so a run of probes is one row: a block and an equal window always meet, and
all windows are probed at the price of one row for every 16 characters. Hits on one diagonal of two
texts are extended to maximal exact repeats by comparing the texts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

_POS_BITS = 21
_CHUNK = 1_000_000
_HELD = 1_000_000  # rows a task holds before it packs them by bucket
_HOT = 1000  # rows of one window in a batch of texts beyond which they don't travel to its bucket
_SUMS = (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.bool_)
_KEY_BYTES = 6  # of the keys of anchors; what they hit is compared in full later
_COARSE = 4096  # buckets one exchange packs to at most
_TASKS = 100_000  # tasks of one exchange at most; beyond that a task takes several buckets, one after the other
_BASE = 0x2545F4914F6CDD1D
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up = np.ones(size, np.uint64)
        down = np.ones(size, np.uint64)
        up[1:] = np.cumprod(np.full(size - 1, _BASE, np.uint64))
        down[1:] = np.cumprod(np.full(size - 1, pow(_BASE, -1, 2**64), np.uint64))
        _POWERS[size] = up, down
    return _POWERS[size]


def rolling_hash(cp: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every window of ``k`` code points."""
    n = len(cp) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(cp) + 1)
    v = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(32)
    total = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(v * up[: len(cp)], out=total[1:])
    h = (total[k:] - total[:-k]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def anchors(cp: np.ndarray, starts: np.ndarray, block: int, sub: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(at, key, is_block)`` of the sub-windows that windows of ``block`` code points go by.

    ``cp`` holds texts end to end, ``starts`` where each begins. Of every window inside one text
    the leftmost sub-window (of ``sub`` code points) of least hash is taken, each once;
    ``is_block`` marks those taken for a window that begins at a multiple of ``block``.
    """
    width = block - sub + 1
    n = len(cp) - block + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    h = rolling_hash(cp, sub)
    low = np.uint64((1 << _POS_BITS) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    least = least[:n]
    ends = np.append(starts[1:], len(cp))
    text_of = np.repeat(np.arange(len(starts)), ends - starts)[:n]
    offset = np.arange(n) - starts[text_of]
    inside = np.arange(n) + block <= ends[text_of]
    at = (least & low).astype(np.int64)
    taken = np.zeros(len(h), bool)
    taken[at[inside]] = True
    block_at = np.zeros(len(h), bool)
    block_at[at[inside & (offset % block == 0)]] = True
    sel = np.flatnonzero(taken)
    return sel, h[sel], block_at[sel]


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.dtype.itemsize))], np.int64).tobytes()
    body = pa.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), codec="zstd", asbytes=True)
    size = np.array([sum(a.nbytes for a in arrays)], np.int64).tobytes()
    return head + size + body


def _unpack(raw: bytes, dtypes: tuple) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
    total = int(np.frombuffer(raw, np.int64, 1, 8 + 16 * n)[0])
    body = pa.decompress(raw[16 + 16 * n :], decompressed_size=total, codec="zstd", asbytes=True) if total else b""
    out, at = [], 0
    for (length, width), kind in zip(sizes, dtypes, strict=True):
        out.append(np.frombuffer(body, kind, int(length), at))
        at += int(length * width)
    return out


def _bucketed(key: np.ndarray, buckets: int, ident: np.ndarray, text_of: np.ndarray, pos: np.ndarray, whole: int = _KEY_BYTES) -> Iterator[tuple[int, bytes]]:
    """One packed row per bucket of rows (key, ident[text_of], pos); ``whole`` bytes of each key."""
    if not len(key):
        return
    b = ((key >> np.uint64(3)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    here, edges = np.unique(b[order], return_index=True)
    for i, a, e in zip(here.tolist(), edges.tolist(), [*edges[1:].tolist(), len(b)], strict=True):
        r = order[a:e]
        who, code = np.unique(text_of[r], return_inverse=True)
        k = np.frombuffer(key[r].tobytes(), np.uint8).reshape(-1, 8)[:, 8 - whole :]
        yield i, _pack(np.ascontiguousarray(k).ravel(), ident[who], np.diff(code, prepend=0).astype(np.int32), np.diff(pos[r], prepend=0).astype(np.int64))


def _packed_places(ident: np.ndarray, text_of: np.ndarray, place: np.ndarray) -> bytes:
    order = np.lexsort((place, text_of))
    who, code = np.unique(text_of[order], return_inverse=True)
    return _pack(ident[who], np.diff(code, prepend=0).astype(np.int32), np.diff(place[order], prepend=0))


def _unpacked_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    ident, code, place = _unpack(raw, (np.int64, np.int32, np.int64))
    return ident[np.cumsum(code)], np.cumsum(place)


def _thinned(key: np.ndarray, ident: np.ndarray, pos: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sent, hot)``: which rows need to go to their bucket, and which have a key that is crowded here already.

    Of a key that several texts hold in more than ``cap`` places, ``cap`` + 1 rows tell its bucket so, of two texts at least and with a
    block if there is one; the others stay.
    """
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(k)))
    many = order[np.repeat(size > cap, size)]
    sent = np.ones(len(key), bool)
    if not len(many):
        return np.flatnonzero(sent), many
    at, first, size = _groups(key[many], ident[many], pos[many])
    many, d = many[at], ident[many[at]]
    hot = (size > cap) & (np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first))
    within = np.arange(len(many)) - np.repeat(first, size)
    block = np.maximum.reduceat(np.where(pos[many] & 1, np.arange(len(many)), -1), first)  # the last row that is a block
    told = (within < cap - 1) | (within == np.repeat(size, size) - 1) | (np.arange(len(many)) == np.repeat(block, size))
    told |= (within == cap - 1) & np.repeat((block < first + cap - 1) | (block == first + size - 1), size)
    hot = np.repeat(hot, size)
    sent[many[hot & ~told]] = False
    return np.flatnonzero(sent), many[hot]


def _unbucketed(payloads: list[bytes], whole: int = _KEY_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, idents, places = [], [], []
    for raw in payloads:
        k, ident, code, pos = _unpack(raw, (np.uint8, np.int64, np.int32, np.int64))
        wide = np.zeros((len(code), 8), np.uint8)
        wide[:, 8 - whole :] = k.reshape(-1, whole)
        keys.append(wide.view("<u8").ravel())
        idents.append(ident[np.cumsum(code)])
        places.append(np.cumsum(pos))
    return np.concatenate(keys), np.concatenate(idents), np.concatenate(places)


def _slices(texts: list[str], most: int) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """Texts (long ones in chunks that overlap) laid end to end: numbers, offsets in the text, code points, starts."""
    who, base, parts, size = [], [], [], 0
    for i, t in enumerate(texts):
        cp = _points(t)
        for a in range(0, max(1, len(cp)), _CHUNK):
            part = cp[a : a + _CHUNK + most]
            if a and len(part) <= most:
                break
            if size and size + len(part) > _CHUNK:
                yield who, base, np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts])[:-1])
                who, base, parts, size = [], [], [], 0
            who.append(i)
            base.append(a)
            parts.append(part)
            size += len(part)
    if size:
        yield who, base, np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts])[:-1])


def _groups(key: np.ndarray, ident: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, ident and place without repeats; starts and sizes of the groups of one key."""
    order = np.lexsort((pos, ident, key))
    k, d, p = key[order], ident[order], pos[order]
    fresh = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (p[1:] != p[:-1])) if len(k) else np.zeros(0, bool)
    order = order[fresh]
    k = key[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(k)))


def match_bucket(key: np.ndarray, ident: np.ndarray, pos: np.ndarray, cap: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, np.ndarray]]:
    """Of the rows of one bucket: ``(x, y, diagonal, place in x)`` of hits, and ``(ident, place)`` of crowded keys.

    ``pos`` is 2 * place + is_block. A hit joins a block with an equal sub-window of another text, x < y.
    Keys that several texts hold in more than ``cap`` places, a block among them, are crowded: their rows are given singly.
    """
    order, first, size = _groups(key, ident, pos)
    ident, pos = ident[order], pos[order]
    if not len(ident):
        none = np.zeros(0, np.int64)
        return (none, none, none, none), (none, none)
    place, is_block = pos >> 1, (pos & 1).astype(bool)
    several = np.minimum.reduceat(ident, first) != np.maximum.reduceat(ident, first)
    several &= np.logical_or.reduceat(is_block, first)
    group = np.repeat(np.arange(len(first)), size)
    crowded = np.repeat(several & (size > cap), size)
    live = np.flatnonzero(np.repeat(several & (size <= cap), size))
    g, d, p, b = group[live], ident[live], place[live], is_block[live]
    out: list[tuple[np.ndarray, ...]] = []
    for step in range(1, cap):
        if step >= len(g):
            break
        hit = np.flatnonzero((g[step:] == g[:-step]) & (d[step:] != d[:-step]) & (b[step:] | b[:-step]))
        if not len(hit) and not (g[step:] == g[:-step]).any():
            break
        out.append((d[hit], d[hit + step], p[hit + step] - p[hit], p[hit]))
    hits = tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4))
    return hits, (ident[crowded], place[crowded])


def _mix(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of the columns."""
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h ^= p.astype(np.int64).view(np.uint64)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return h


def _weight(ident: np.ndarray, more: np.ndarray) -> np.ndarray:
    return _mix(ident, more) | np.uint64(1)


def stands(key: np.ndarray, ident: np.ndarray, place: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """``(key, ident, first, more)`` of places of windows, ordered by key, ident and place, one row per stand.

    A stand is a place, or places of one text at most half a window apart (a text of short period), from ``first`` to
    ``first + more``.
    """
    order, _, _ = _groups(key, ident, place)
    k, d, p = key[order], ident[order], place[order]
    if not len(d):
        return k, d, p, p
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1]) & (p[1:] - p[:-1] <= least // 2)
    at = np.flatnonzero(np.append(True, ~same))
    return k[at], d[at], p[at], p[np.append(at[1:], len(p)) - 1] - p[at]


def window_sums(k: np.ndarray, d: np.ndarray, p: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of stands ordered by key, per key ``(key, a, b, ident, lead, several)``: sums that parts of the stands can be added up from.

    ``a`` sums a weight of each stand's text, ``b`` the weights times places, both modulo 2**64; ``ident`` is the least text, ``lead`` its
    first place, ``several`` whether there is another.
    """
    if not len(k):
        return k, k, k, d, p, np.zeros(0, bool)
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    w = _weight(d, more)
    last = np.append(at[1:], len(k)) - 1
    return k[at], np.add.reduceat(w, at), np.add.reduceat(w * p.astype(np.uint64), at), d[at], p[at], d[at] != d[last]


def added(k: np.ndarray, a: np.ndarray, b: np.ndarray, d: np.ndarray, p: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, ...]:
    """``window_sums`` of several parts, added up by key."""
    order = np.lexsort((p, d, k))
    k, a, b, d, p, several = (x[order] for x in (k, a, b, d, p, several))
    if not len(k):
        return k, a, b, d, p, several
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    last = np.append(at[1:], len(k)) - 1
    return k[at], np.add.reduceat(a, at), np.add.reduceat(b, at), d[at], p[at], np.logical_or.reduceat(several, at) | (d[at] != d[last])


def signs(a: np.ndarray, b: np.ndarray, d: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """A hash of whose stands a key's are and of how all lie to the lead: where all stands move one place on, it stays."""
    return _mix(d, a.view(np.int64), (b - lead.astype(np.uint64) * a).view(np.int64))


def window_classes(key: np.ndarray, ident: np.ndarray, place: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of windows of ``least`` that stand in several texts: ``(ident, first, more, lead, sign)``, one row per stand.

    ``lead`` is the first place of the class's least text, ``sign`` as in ``signs``: windows of equal sign whose leads are
    neighbours have the same stands, one place on.
    """
    k, d, p, more = stands(key, ident, place, least)
    return _told(k, d, p, more, *window_sums(k, d, p, more))


def _told(k: np.ndarray, d: np.ndarray, p: np.ndarray, more: np.ndarray, keys: np.ndarray, a: np.ndarray, b: np.ndarray, least_ident: np.ndarray, lead: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stands with the lead and sign of their key, of keys that stand in several texts."""
    if not len(k) or not len(keys):
        return (*[np.zeros(0, np.int64)] * 4, np.zeros(0, np.uint64))
    of = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
    here = (keys[of] == k) & several[of]
    of = of[here]
    return d[here], p[here], more[here], lead[of], signs(a, b, least_ident, lead)[of]


def class_spans(ident: np.ndarray, first: np.ndarray, more: np.ndarray, lead: np.ndarray, sign: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Rows of ``window_classes`` with neighbours joined while their stands are the same: ``(ident, start, end, class, class_chars)``."""
    order = np.lexsort((first, ident))
    d, p, m, r, g = ident[order], first[order], more[order], lead[order], sign[order]
    on = (d[1:] == d[:-1]) & (p[1:] == p[:-1] + 1) & (m[1:] == m[:-1]) & (r[1:] == r[:-1] + 1) & (g[1:] == g[:-1])
    at = np.flatnonzero(np.append(True, ~on)) if len(d) else np.zeros(0, np.int64)
    chars = np.diff(np.append(at, len(d))) - 1 + least
    return d[at], p[at], p[at] + m[at] + chars, _mix(g[at].view(np.int64), r[at], chars).view(np.int64), chars


def equal_runs(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of at least ``least`` in which ``a`` and ``b`` agree."""
    same = np.concatenate([[False], a == b, [False]])
    edge = np.flatnonzero(same[1:] != same[:-1])
    return [(int(s), int(e)) for s, e in zip(edge[::2], edge[1::2], strict=True) if e - s >= least]


def covered(intervals: list[tuple[int, int]]) -> int:
    total, end = 0, 0
    for a, b in sorted(intervals):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def _bucket_count(docs: DataFrame) -> int:
    """As many buckets as make each some hundred thousand rows, by the size of the input; at least twice the shuffle partitions."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = max(12, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, size // 4_000_000) if size < 2**55 else least


def _ident(text: str) -> Column:
    return F.xxhash64(F.col(text), F.length(text))


def shared_parts(docs: DataFrame, *, text: str, least: int = 200, cap: int = 4, buckets: int | None = None, whole: bool = True) -> DataFrame:
    """Shared stretches of distinct texts: (ident, start, end, partner, partner_start, class, class_chars).

    ``ident`` is a 64-bit hash of a text, so exact copies are one. Every maximal exact repeat of at
    least ``least`` code points between two texts that meet at an anchor of at most ``cap`` places
    is given, for either text, with its partner (without ``whole``, it may end where crowded anchors begin).
    Where an anchor has more places than that, windows of ``least`` code points around them are counted instead, linear
    in the crowd, and given with a null partner and the class of texts that hold them:

    * Neighbouring windows are one row as long as the same texts hold them at the same distances, so a passage is
      one row in each text that holds it, and all those have one ``class``. ``class_chars`` is the length of what they share.
    * Where other texts join or leave, a row ends and the next begins ``least`` - 1 before that end. Two texts share what their common
      classes cover one after the other.
    * A row longer than ``class_chars`` is of short period: copies of the class's text, each at most half of ``least`` after the one before, cover it.

    Either way no stretch and no link is lost: the union over a text's rows is exactly what it shares with others,
    and any two texts that share ``least`` code points have them in a row of the pair or in rows of one class.
    """
    block, sub = least // 2, max(1, least * 35 // 100)
    reach = 2 * block - sub  # from a hit, past the rest of its block, to where the next block would be whole
    nb = buckets or _bucket_count(docs)
    src = docs.where(F.length(text) >= least).select(_ident(text).alias("ident"), F.col(text).alias("text"))

    most_held, coarse = _HELD, min(nb, _COARSE)  # buckets of the first exchange; more are made of them by a second one

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, whose, places, idents, held, texts = [], [], [], [], 0, 0
        seen: set[int] = set()  # copies of a text go once from each task
        turn = 0

        def packed() -> pa.RecordBatch:
            nonlocal turn
            key, who, pos, ident = np.concatenate(keys), np.concatenate(whose), np.concatenate(places), np.concatenate(idents)
            sent, hot = _thinned(key, ident[who], pos, cap)
            rows = list(_bucketed(key[sent], coarse, ident, who[sent], pos[sent]))
            if len(hot):  # crowded rows pass the exchange in buckets of their own, below 0
                rows.append((-1 - int(_mix(ident[:1], np.array([turn]))[0] % np.uint64(coarse)), _packed_places(ident, who[hot], pos[hot] >> 1)))
                turn += 1
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "payload"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            fresh = [i for i, d in enumerate(ids.tolist()) if not (d in seen or seen.add(d))]
            idents.append(ids[fresh])
            for who, base, cp, starts in _slices(batch.column(1).take(pa.array(fresh, pa.int64())).to_pylist(), block - 1):
                at, key, is_block = anchors(cp, starts, block, sub)
                part = np.searchsorted(starts, at, "right") - 1
                keys.append(key)
                whose.append(np.array(who, np.int64)[part] + texts)
                places.append((at - starts[part] + np.array(base, np.int64)[part]) * 2 + is_block)
                held += len(key)
            texts += len(fresh)
            if held >= most_held:
                yield packed()
                keys, whose, places, idents, held, texts = [], [], [], [], 0, 0
        if keys:
            yield packed()

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b < 0:
                    rows.append((b, raw))
                else:
                    key, ident, pos = _unbucketed([raw])
                    who, code = np.unique(ident, return_inverse=True)
                    rows += _bucketed(key, nb, who, code, pos)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "payload"])

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            crowd = tuple(np.concatenate(c) for c in zip(*map(_unpacked_places, pdf["payload"]), strict=True))
            hits = (np.zeros(0, np.int64),) * 4
        else:
            hits, crowd = match_bucket(*_unbucketed(list(pdf["payload"])), cap)
        cold = pd.DataFrame(dict(zip(("x", "y", "diagonal", "place"), hits, strict=True))).groupby(["x", "y", "diagonal"], as_index=False)["place"].agg(["min", "max"])
        cold = pd.DataFrame({"x": cold["x"], "y": cold["y"], "diagonal": cold["diagonal"], "lo": cold["min"], "hi": cold["max"]})
        hot = pd.DataFrame({"x": crowd[0], "y": pd.array([None] * len(crowd[0]), "Int64"), "diagonal": 0, "lo": crowd[1], "hi": crowd[1]})
        return pd.concat([cold.astype({"y": "Int64"}), hot]) if len(hot) else cold

    packed_rows = "bucket int, payload binary"
    spread = lambda rows, n: rows.repartition(min(4 * n, _TASKS), "bucket")  # more tasks than buckets, so that few share one
    rows = src.mapInArrow(index, packed_rows)
    if coarse < nb:
        rows = spread(rows, coarse).mapInArrow(refine, packed_rows)
    hits = spread(rows, nb).groupBy("bucket").applyInPandas(match, "x bigint, y bigint, diagonal bigint, lo bigint, hi bigint")
    hits = written(hits, "span-hits")
    cold = hits.where(F.col("y").isNotNull()).groupBy("x", "y", "diagonal").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    crowd = hits.where(F.col("y").isNull()).groupBy(F.col("x").alias("ident")).agg(F.collect_set("lo").alias("qs"))
    ask = cold.groupBy(F.col("x").alias("ident")).agg(F.collect_list(F.struct("y", "diagonal", "lo", "hi")).alias("qs"))
    unique = src.groupBy("ident").agg(F.first("text").alias("text"))  # one exchange, used by all three joins
    with_text = lambda asked: asked.join(unique, "ident").select("ident", "qs", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for x, qs, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for q in qs:
                    a, b = max(0, q["lo"] - reach), min(len(text), q["hi"] + sub + reach)
                    for c, v in zip(cols, (q["y"], x, q["diagonal"], a, text[a:b], b < len(text)), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["ident", "x", "diagonal", "a", "part", "more"])

    parts = with_text(ask).mapInArrow(cut, "ident bigint, x bigint, diagonal bigint, a bigint, part string, more boolean")
    parts = parts.groupBy("ident").agg(F.collect_list(F.struct("x", "diagonal", "a", "part", "more")).alias("qs"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for y, qs, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                there = _points(text)
                for q in qs:
                    here, x, d = _points(q["part"]), q["x"], q["diagonal"]
                    a, b = max(q["a"], -d), min(q["a"] + len(here), len(there) - d)
                    if b - a < least:
                        continue
                    for s, e in equal_runs(here[a - q["a"] : b - q["a"]], there[a + d : b + d], least):
                        s, e = a + s, a + e
                        # the stretch may go on outside the part: 1 before it, 2 after it
                        on = (s == q["a"] and s > 0 and s + d > 0) + 2 * (q["more"] and e == q["a"] + len(here) and e + d < len(there))
                        for c, v in zip(cols, (x, y, d, s, e, on), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["x", "y", "diagonal", "start", "end", "on"])

    crowded_texts = _HOT

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, who, place = [], [], []
            for i, (qs, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                cp, done = _points(text), 0
                for q in sorted(qs):
                    a, b = max(0, q - reach, done), min(len(text), q + sub + reach)
                    h = rolling_hash(cp[a:b], least)
                    key.append(h)
                    who.append(np.full(len(h), i))
                    place.append(np.arange(a, a + len(h)))
                    done = max(done, a + len(h))
            rows = []
            if key:
                ident, key, who, place = batch.column(0).to_numpy(zero_copy_only=False), np.concatenate(key), np.concatenate(who), np.concatenate(place)
                _, code, size = np.unique(key, return_inverse=True, return_counts=True)
                hot = size[code] > crowded_texts
                rows = [(b, 0, raw) for b, raw in _bucketed(key[~hot], nb, ident, who[~hot], place[~hot], 8)]
                if hot.any():  # of a window that so many texts of one batch hold, its bucket gets sums; the rows wait for what all batches add up to
                    k, d, p, more = stands(key[hot], ident[who[hot]], place[hot], least)
                    sums = window_sums(k, d, p, more)
                    part = (sums[0] >> np.uint64(3)) % np.uint64(nb)
                    for b in np.unique(part):
                        rows.append((int(b), 1, _pack(*(x[part == b] for x in sums))))
                    rows.append((-1 - int(_mix(ident[:1], place[:1])[0] % np.uint64(2**31)), 2, _pack(k, d, p, more)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "kind", "payload"])

    def by_text(d: np.ndarray, p: np.ndarray, more: np.ndarray, lead: np.ndarray, sign: np.ndarray) -> Iterator[tuple[int, bytes]]:
        b = (d.view(np.uint64) % np.uint64(nb)).astype(np.int64)
        for i in np.unique(b):
            r = np.flatnonzero(b == i)
            r = r[np.lexsort((p[r], d[r]))]
            who, code = np.unique(d[r], return_inverse=True)
            yield int(i), _pack(who, np.diff(code, prepend=0).astype(np.int32), np.diff(p[r], prepend=0), more[r], np.diff(lead[r] - p[r], prepend=0), sign[r])

    def classes(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            return pdf
        rows, parts = pdf["payload"][pdf["kind"] == 0], pdf["payload"][pdf["kind"] == 1]
        k, d, p, more = stands(*_unbucketed(list(rows), 8), least) if len(rows) else [np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64)]
        sums = window_sums(k, d, p, more)
        out: list[tuple[int, int, bytes]] = []
        if len(parts):
            told = [_unpack(raw, _SUMS) for raw in parts]
            sums = added(*(np.concatenate(c) for c in zip(sums, *told, strict=True)))
            asked = np.isin(sums[0], np.concatenate([t[0] for t in told]))
            out.append((-1, 1, _pack(*(x[asked] for x in sums))))
        out += [(b, 0, raw) for b, raw in by_text(*_told(k, d, p, more, *sums))]
        return pd.DataFrame(out, columns=["bucket", "kind", "payload"])

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                k = np.unique(_unpack(raw, (np.uint64, np.int64, np.int64, np.int64))[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i), pa.int64()), pa.array(k.view(np.int64))], names=["waits", "key"])

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(2).to_pylist():
                cols = _unpack(raw, _SUMS)
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols[:5]] + [pa.array(cols[5])], names=["key", "a", "b", "d", "p", "several"])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cols = [np.array([x[c] for x in sums], bool if c == "several" else np.int64) for c in ("key", "a", "b", "d", "p", "several")]
                keys = cols[0].view(np.uint64)
                order = np.argsort(keys)
                told = (keys[order], cols[1].view(np.uint64)[order], cols[2].view(np.uint64)[order], *(c[order] for c in cols[3:]))
                rows = list(by_text(*_told(*_unpack(raw, (np.uint64, np.int64, np.int64, np.int64)), *told)))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "payload"])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        held = []
        for raw in pdf["payload"]:
            who, code, p, more, lead, sign = _unpack(raw, (np.int64, np.int32, np.int64, np.int64, np.int64, np.uint64))
            p = np.cumsum(p)
            held.append((who[np.cumsum(code)], p, more, np.cumsum(lead) + p, sign))
        rows = class_spans(*(np.concatenate(c) for c in zip(*held, strict=True)), least)
        none = pd.array([None] * len(rows[0]), "Int64")
        return pd.DataFrame({"ident": rows[0], "start": rows[1], "end": rows[2], "partner": none, "partner_start": none, "class": rows[3], "class_chars": rows[4]})

    runs = with_text(parts).mapInArrow(extend, "x bigint, y bigint, diagonal bigint, start bigint, end bigint, on bigint")
    if whole:
        runs = _extended(runs, src)
    there = lambda c: F.col(c) + F.col("diagonal")
    here = F.struct(F.col("x").alias("ident"), "start", "end", F.col("y").alias("partner"), there("start").alias("partner_start"))
    back = F.struct(F.col("y").alias("ident"), there("start").alias("start"), there("end").alias("end"), F.col("x").alias("partner"), F.col("start").alias("partner_start"))
    none = F.lit(None).cast("bigint")
    pairs = runs.select(F.explode(F.array(here, back)).alias("r")).select("r.*", none.alias("class"), none.alias("class_chars"))
    kinds = "bucket int, kind int, payload binary"
    found = written(spread(with_text(crowd).mapInArrow(windows, kinds), nb).groupBy("bucket").applyInPandas(classes, kinds), "span-classes")
    waiting = found.where("kind = 2")
    asked = waiting.mapInArrow(keys_of, "waits bigint, key bigint")
    sums = found.where("kind = 1").mapInArrow(sums_of, "key bigint, a bigint, b bigint, d bigint, p bigint, several boolean")
    told = asked.join(sums, "key").groupBy("waits").agg(F.collect_list(F.struct("key", "a", "b", "d", "p", "several")).alias("sums"))  # at most the keys of one batch
    late = waiting.join(told, F.col("bucket") == F.col("waits")).select("payload", "sums").mapInArrow(answered, packed_rows)
    texts = found.where("kind = 0").select("bucket", "payload").unionByName(late)
    crowds = spread(texts, nb).groupBy("bucket").applyInPandas(joined, pairs.schema)
    return pairs.unionByName(crowds)


def _extended(runs: DataFrame, src: DataFrame) -> DataFrame:
    """Runs (x, y, diagonal, start, end) of two texts to their full length.

    Those that may go on (``on``) are compared further in rounds, each over four times the stretch of the last, so that what
    is sent is of the order of what is shared.
    """
    runs = written(runs, "span-runs")
    done, step = [runs.where(F.col("on") == 0).drop("on")], 1024
    left = runs.where(F.col("on") > 0)
    names = ["x", "y", "diagonal", "start", "end", "on"]
    kinds = ", ".join(f"{c} bigint" for c in names)

    def with_text(rows: DataFrame, ident: str) -> DataFrame:
        asked = rows.groupBy(F.col(ident).alias("ident")).agg(F.collect_list(F.struct(*rows.columns)).alias("qs"))
        return asked.join(src.join(asked.select("ident"), "ident", "left_semi").groupBy("ident").agg(F.first("text").alias("text")), "ident").select("qs", "text")

    while left.limit(1).count():

        def cut(batches: Iterator[pa.RecordBatch], step: int = step) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for qs, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for q in qs:
                        before = text[max(0, q["start"] - step) : q["start"]] if q["on"] & 1 else ""
                        after = text[q["end"] : q["end"] + step] if q["on"] & 2 else ""
                        rows.append((*(q[c] for c in names), len(text), before, after))
                cols = list(zip(*rows, strict=True)) or [()] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 7 else pa.string()) for i, c in enumerate(cols)], names=[*names, "size", "before", "after"])

        def compare(batches: Iterator[pa.RecordBatch], step: int = step) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for qs, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for q in qs:
                        s, e, d, on = q["start"], q["end"], q["diagonal"], q["on"]
                        n = _common(q["before"][::-1], text[max(0, s + d - len(q["before"])) : s + d][::-1])
                        m = _common(q["after"], text[e + d : e + d + len(q["after"])])
                        s, e = s - n, e + m
                        on = (n == step and s > 0 and s + d > 0) + 2 * (m == step and e < q["size"] and e + d < len(text))
                        rows.append((q["x"], q["y"], d, s, e, on))
                cols = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        parts = with_text(left, "x").mapInArrow(cut, kinds + ", size bigint, before string, after string")
        seen = written(with_text(parts, "y").mapInArrow(compare, kinds), "span-runs")
        done.append(seen.where(F.col("on") == 0).drop("on"))
        left, step = seen.where(F.col("on") > 0), step * 4
    return reduce(DataFrame.unionByName, done)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    p, q = _points(a), _points(b)
    n = min(len(p), len(q))
    off = np.flatnonzero(p[:n] != q[:n])
    return int(off[0]) if len(off) else n


def shared_chars(docs: DataFrame, *, key: str, text: str, least: int = 200, **options) -> DataFrame:
    """(key, n_chars, copies, shared_chars) of the rows that share a span of ``least`` code points with another row.

    ``shared_chars`` counts the code points that lie in at least one such span; a text with exact copies shares all of
    itself. A span that comes again only within its own text is not shared. Null, empty and short texts share
    nothing. Each row of the table is a document, also with null or equal keys; other columns are ignored.
    """
    parts = shared_parts(docs, text=text, least=least, whole=False, **options)
    per = parts.groupBy("ident").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"ident": pdf["ident"], "found": [covered([(s["start"], s["end"]) for s in spans]) for spans in pdf["spans"]]})

    per = per.mapInPandas(measure, "ident bigint, found bigint")
    rows = docs.where(F.length(text) >= least).select(F.col(key).alias("key_"), _ident(text).alias("ident"), F.length(text).cast("bigint").alias("n_chars"))
    copies = rows.groupBy("ident").agg(F.count(F.lit(1)).alias("copies"))
    known = copies.join(per, "ident", "left").where((F.col("copies") > 1) | F.col("found").isNotNull())
    shared = F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.col("found"))
    return rows.join(known, "ident").select(F.col("key_").alias(key), "n_chars", "copies", shared.alias("shared_chars"))


def shared_spans(docs: DataFrame, *, key: str, text: str, least: int = 200, **options) -> DataFrame:
    """(key, ident, start, end, partner, partner_start, class, class_chars): the shared stretches of every row of the table, whole copies among them.

    ``ident`` is the class of exact copies a row belongs to, and ``partner`` the class that holds the stretch too, at
    ``partner_start``; where many hold it, ``class`` stands for them (see ``shared_parts``). A row with exact copies has one stretch more, its whole text, whose partner is its own class: copies
    are found by their class, not in pairs, so a text that a third of all rows hold gives each of them one such row.
    Rows of the table are documents, as in ``shared_chars``.
    """
    parts = shared_parts(docs, text=text, least=least, **options)
    rows = docs.where(F.length(text) >= least).select(F.col(key).alias("key_"), _ident(text).alias("ident"), F.length(text).cast("bigint").alias("n_chars"))
    copied = rows.groupBy("ident").agg(F.count(F.lit(1)).alias("copies"), F.first("n_chars").alias("end")).where(F.col("copies") > 1)
    zero = F.lit(0).cast("bigint")
    whole = copied.select("ident", zero.alias("start"), "end", F.col("ident").alias("partner"), zero.alias("partner_start"))
    return rows.drop("n_chars").join(parts.unionByName(whole, allowMissingColumns=True), "ident").select(F.col("key_").alias(key), *parts.columns)
