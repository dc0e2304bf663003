"""Claims as text: their normal form, what of it is wording, learned from a corpus, and whether two claims state the same."""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

_CJK = "㐀-鿿豈-﫿"
_TOKEN = re.compile(rf"\d{{1,3}}(?:,\d{{3}})+(?![\d,])(?:\.\d+)?|\d+(?:\.\d+)?|[{_CJK}]|[^\W\d_{_CJK}]+(?:['’&-][^\W\d_{_CJK}]+)*\d*|[^\s\w]|_")
_ONE_CJK = re.compile(rf"[{_CJK}]")
_PER_CENT = re.compile(r"\bper\s*cent\b")
_COMPANY_BITS = 63
_HELD = 200_000  # words whose reading a worker keeps, so that each is read once


class Token(NamedTuple):
    text: str
    kind: str  # number, word, han (one Chinese character) or mark


_SEEN: dict[str, Token] = {}


def tokens(text: str | None) -> list[Token]:
    """Numbers in one writing, words in lower case, Chinese characters one by one, marks; compatibility forms folded, "per cent" written %."""
    t = unicodedata.normalize("NFKC", text or "").casefold()
    if "cent" in t:
        t = _PER_CENT.sub("%", t)
    return [_SEEN.get(w) or _token(w) for w in _TOKEN.findall(t)]


def _token(w: str) -> Token:
    if w[0].isdigit() and w[0].isascii():
        t = Token(number(w), "number")
    elif _ONE_CJK.match(w):
        t = Token(w, "han")
    else:
        t = Token(w, "word" if w[0].isalnum() else "mark")
    if len(_SEEN) >= _HELD:
        _SEEN.clear()
    _SEEN[w] = t
    return t


def number(x: str) -> str:
    """A decimal number without separators, leading zeros and trailing zeros after the point."""
    x = x.replace(",", "").lstrip("0") or "0"
    x = x if x[0] != "." else "0" + x
    return x.rstrip("0").rstrip(".") if "." in x else x


def stated_number(value_json: str | None) -> str | None:
    """The number a JSON value holds, bare or in quotes."""
    try:
        v = json.loads(value_json, parse_float=str, parse_int=str) if value_json else None
    except ValueError:
        v = value_json
    v = unicodedata.normalize("NFKC", v).strip() if isinstance(v, str) else ""
    return number(v) if re.fullmatch(r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?", v) else None


def label(x: str | None) -> str | None:
    """A column's value trimmed, in compatibility form and lower case; blank is null."""
    return " ".join(unicodedata.normalize("NFKC", x or "").casefold().split()) or None


def slips(a: str, b: str) -> int:
    """0 if equal, 1 if a character was lost, added, changed or two neighbours swapped, else 2."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    if len(a) + 1 == len(b):
        return 1 if a[i:] == b[i + 1 :] else 2
    if len(a) == len(b):
        swapped = i + 1 < len(a) and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :]
        return 1 if swapped or a[i + 1 :] == b[i + 1 :] else 2
    return 2


def _shorter(word: str) -> Iterator[str]:
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]


class Wording:
    """What ``learn_wording`` found: ``said``, tokens that are wording and pairs of Chinese characters, and ``values``, column (0 metric, 1 period) -> token -> values it goes with."""

    def __init__(self, rows: Iterable[tuple[str, int | None, str | None]]):
        self.said: set[str] = set()
        self.values: tuple[dict[str, set[str]], dict[str, set[str]]] = ({}, {})
        for token, which, value in rows:
            self.said.add(token)
            if which is not None:
                self.values[which].setdefault(token, set()).add(value)
        self.read: dict[Token, str | None] = {}
        self.near: dict[str, list[str]] = {}
        for w in self.said:
            if len(w) >= 2 and w.isascii() and w.isalpha():
                for s in _shorter(w):
                    self.near.setdefault(s, []).append(w)

    def meant(self, token: Token) -> str | None:
        """The wording a token is, or is one slip away from (two-letter words: swapped only)."""
        if token.text in self.said:
            return token.text
        if token not in self.read:
            if len(self.read) >= _HELD:
                self.read.clear()
            self.read[token] = self._slip_of(token)
        return self.read[token]

    def _slip_of(self, token: Token) -> str | None:
        w = token.text
        if token.kind != "word" or not w.isascii() or not w.isalpha():
            return None
        found = {v for s in (*_shorter(w), w) for v in self.near.get(s, ())} | {s for s in _shorter(w) if s in self.said}
        found = {v for v in found if slips(v, w) == 1 and (len(v) > 3 or (len(v) == len(w) and sorted(v) == sorted(w)))}
        return min(found, key=lambda v: (len(v) != len(w), v)) if found else None


def label_tokens(ts: list[Token], said) -> set[str]:
    """Wording that may go with a column: words and numbers, and Chinese characters two by two, as one alone says little."""
    out = {t.text for t in ts if t.kind in ("word", "number") and t.text in said}
    return out | {a.text + b.text for a, b in zip(ts, ts[1:], strict=False) if a.kind == b.kind == "han" and a.text in said and b.text in said}


class Claim(NamedTuple):
    content: str  # what sets the claim apart, in one order: what is cut into chunks
    numbers: str
    turns: str  # words before percentages
    kept: str  # words that are no wording
    company: str | None
    metric: str | None
    period: str | None
    value: str | None
    metrics: list[str]  # values of metric that most of its words go with, where none is stated
    periods: list[str]


def turns(ts: list[Token], wording: Wording) -> str:
    """Up to two words (two Chinese characters) right before each percentage, after the last number or mark: which way it goes."""
    out = []
    for i in range(1, len(ts)):
        if ts[i].text == "%" and ts[i - 1].kind == "number":
            before: list[str] = []
            for t in reversed(ts[max(0, i - 3) : i - 1]):
                if t.kind not in ("word", "han"):
                    break
                before.append(wording.meant(t) or t.text)
            out.append(" ".join(reversed(before)))
    return "|".join(out)


def claim_of(text: str | None, company: str | None, metric: str | None, period: str | None, value_json: str | None, wording: Wording) -> Claim:
    ts = tokens(text)
    numbers = sorted(t.text for t in ts if t.kind == "number")
    words, han, meant = [], [], []
    for t in ts:
        if t.kind == "mark":
            continue
        w = wording.meant(t)
        if w is not None:
            meant.append(t if w == t.text else Token(w, t.kind))
        elif t.kind == "han":
            han.append(t.text)
        elif t.kind == "word":
            words.append(t.text)
    stated = (label(metric), label(period))
    told = set() if all(stated) else label_tokens(meant, wording.said)
    likely: list[list[str]] = []
    for values, own in zip(wording.values, stated, strict=True):
        votes = Counter(v for w in told for v in values.get(w, ())) if not own else {}
        most = max(votes.values(), default=0)
        likely.append(sorted(v for v, n in votes.items() if n == most))
    apart = sorted((n for n in numbers if n not in wording.said), key=lambda n: (-len(n), n))
    if len(apart) < 2:  # too little to tell it by its numbers: every word counts
        words, han = [t.text for t in ts if t.kind == "word"], [t.text for t in ts if t.kind == "han"]
    kept = " ".join([*sorted(words), "".join(han)]).strip()
    content = " ".join([*apart, kept]).strip() or " ".join(t.text for t in ts)
    return Claim(content, " ".join(numbers), turns(ts, wording), kept, label(company), *stated, stated_number(value_json), *likely)


def _one_slip(a: str, b: str, least: int) -> bool:
    """Equal word by word but for one slip in one word of ``least`` Latin letters or more."""
    x, y = Counter(a.split(" ")), Counter(b.split(" "))
    p, q = list((x - y).elements()), list((y - x).elements())
    return not p and not q or (len(p) == len(q) == 1 and min(len(p[0]), len(q[0])) >= least and p[0].isascii() and q[0].isascii() and slips(p[0], q[0]) == 1)


def agree(a: Claim, b: Claim, wording: Wording) -> bool:
    """Whether two claims state the same.

    All numbers are the same; so are the words before percentages, but for a slip that is no word of its own, and the
    words that are no wording, but for one slip. Columns that both state agree (the company but for one slip); where one leaves metric
    or period open, its words go most with the value that the other states, and where both do, with the same values.
    """
    if a.numbers != b.numbers or not _one_slip(a.kept, b.kept, 5):
        return False
    for x, y in zip(a.turns.split("|"), b.turns.split("|"), strict=False):
        if x != y and (slips(x, y) > 1 or (x in wording.said and y in wording.said)):
            return False
    if a.company and b.company and not _one_slip(a.company, b.company, 5):
        return False
    if a.value and b.value and a.value != b.value:
        return False
    return _same(a.metric, b.metric, a.metrics, b.metrics) and _same(a.period, b.period, a.periods, b.periods)


def _same(x: str | None, y: str | None, xs: list[str], ys: list[str]) -> bool:
    if x and y:
        return x == y
    if not x and not y:
        return xs == ys
    return (x or y) in (ys if x else xs) or (not xs and not ys)


def count_claims(claims: Iterable[tuple]) -> Iterator[tuple[str, str, int, int, int, int]]:
    """(token, kind, claims, claims with a company, of those in its name, bits of companies) of (claim, company) rows, combined."""
    got: dict[tuple[str, str], list[int]] = {}
    for text, company in claims:
        name = label(company)
        names = {t.text for t in tokens(company)} if name else set()
        bit = 1 << (hash_of(name) % _COMPANY_BITS) if name else 0
        for t in set(tokens(text)):
            if t.kind != "mark":
                row = got.setdefault((t.text, t.kind), [0, 0, 0, 0])
                row[0] += 1
                row[1] += bool(name)
                row[2] += t.text in names
                row[3] |= bit
    for (text, kind), row in got.items():
        yield (text, kind, *row)


def hash_of(x: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(x)


def count_labels(claims: Iterable[tuple], wording: frozenset[str]) -> Iterator[tuple[str, int, str, int]]:
    """(token, which column, its value, claims) of (claim, metric, period) rows, combined; the token "" counts all claims."""
    got: Counter = Counter()
    for text, *labels in claims:
        here = label_tokens(tokens(text), wording)
        for k, x in enumerate(labels):
            if (v := label(x)) is not None:
                got[("", k, v)] += 1
                for w in here:
                    got[(w, k, v)] += 1
    for (w, k, v), n in got.items():
        yield w, k, v, n


def learn_wording(records: DataFrame, *, share: float = 0.01, least: int = 5, least_share: float = 1e-5) -> DataFrame:
    """(token, which, value): what is wording in the claims of a corpus with columns claim, company, metric and period; any of them may be null.

    * A token that stands in its claim's own company in nine of ten claims that name one is part of a name, not wording.
    * Of the others, those in ``share`` of all claims are wording, and words (not numbers) in at least ``least`` claims and
      ``least_share`` of all that come with many companies: with a third as many as claims (companies are counted in 63 bits).
    * Wording (Chinese characters in pairs) goes with a value of metric (``which`` 0) or period (1) if it comes with it twice as often as chance has it, and four standard
      deviations more; ``which`` is null in the row of the token itself. Values are taken as they are; nothing is known of them beforehand.

    All claims are counted, each batch of rows combined before the shuffle. The result has at most 1 / ``least_share`` times the mean number of tokens
    of a claim, usually some hundred rows. No claims give no wording.
    """
    rows = records.select("claim", "company", "metric", "period")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(count_claims(zip(pdf["claim"], pdf["company"], strict=True)), columns=["token", "kind", "n", "known", "named", "bits"])

    per = rows.select("claim", "company").mapInPandas(count, "token string, kind string, n bigint, known bigint, named bigint, bits bigint")
    per = per.groupBy("token", "kind").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("named").alias("named"), F.bit_count(F.bit_or("bits")).alias("spread"))
    total = rows.count()
    name = (F.col("known") > 0) & (F.col("named") >= 0.9 * F.col("known"))
    many = (F.col("kind") != "number") & (F.col("n") >= max(least, least_share * total)) & (F.col("spread") >= F.least("n", F.lit(60)) / 3)
    found = written(per.where(~name & ((F.col("n") >= share * total) | many)).select("token").distinct(), "wording")
    words = frozenset(r.token for r in found.collect())
    sent = records.sparkSession.sparkContext.broadcast(words)

    def by_label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(count_labels(zip(pdf["claim"], pdf["metric"], pdf["period"], strict=True), sent.value), columns=["token", "which", "value", "n"])

    pairs = rows.select("claim", "metric", "period").mapInPandas(by_label, "token string, which int, value string, n bigint")
    pairs = written(pairs.groupBy("token", "which", "value").agg(F.sum("n").alias("n")), "wording-labels")
    base = pairs.where("token = ''").select("which", "value", F.col("n").alias("of_value"))
    every = base.groupBy("which").agg(F.sum("of_value").alias("of_all"))
    mine = pairs.where("token != ''")
    own = mine.groupBy("token", "which").agg(F.sum("n").alias("of_token"))
    chance = F.col("of_token") * F.col("of_value") / F.col("of_all")
    tied = mine.join(base, ["which", "value"]).join(every, "which").join(own, ["token", "which"]).where(F.col("n") >= 2 * chance + 4 * F.sqrt(chance))
    none = F.lit(None)
    return found.select("token", none.cast("int").alias("which"), none.cast("string").alias("value")).unionByName(tied.select("token", "which", "value"))
