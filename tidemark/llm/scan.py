"""Repair of texts that come from scanned pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

HYPHENS = "-‐‑­¬"
LONGEST = 80  # characters of a line whose template is counted over the corpus at most; within a text, lines of any length are compared
EDGE = 3  # lines at the top and at the foot of a page that may be running lines

# What a scan reads in place of what was printed.
DIGIT_FOR = str.maketrans({"O": "0", "o": "0", "l": "1", "I": "1", "Z": "2", "S": "5", "b": "6", "B": "8", "g": "9", "q": "9"})
ALIKE = {"m": "rn", "d": "cl", "w": "vv", "u": "ll", "i": "l", "1": "l", "|": "l", "0": "o", "5": "s", "9": "g", "6": "b", "8": "b", "e": "c", "t": "f", "2": "z"}

_ALIKE = str.maketrans(ALIKE)
_BODY_MARK = re.compile(r"[，。；！？]|[.;!?,]\s*$")
_SENTENCE_END = re.compile(r"[.!?。！？：:]\s*$")
_HAS_LETTER = re.compile(r"[A-Za-z]")
_HAS_DIGIT = re.compile(r"\d")
_WORD = re.compile(r"[A-Za-z0-9]+(?:[-'’.,][A-Za-z0-9]+)*")
_NUMBERISH = re.compile(r"[0-9OolIZSbBgq]+(?:[.,][0-9OolIZSbBgq]+)*")
_NUMBERISH_LOW = re.compile(r"[0-9olizsbgq]+(?:[.,][0-9olizsbgq]+)*")  # _NUMBERISH in lower case
_NUMBER = re.compile(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?")
_READING = re.compile(r"(?<![0-9])[0125689]{2,6}(?![0-9])")  # numbers that letters alone can stand for
_CODE = re.compile(r"[A-Z]{2,}\d{4,}")
_D = r"[0-9OolIZSbBgq]{1,4}"
PAGE_FORMS = (
    re.compile(rf"^[-—–－·\[(（]?\s*({_D})\s*[-—–－·\])）]?$"),
    re.compile(rf"^(?:Page|PAGE|page|[Pp]\.|Pg\.?)\s*({_D})(?:\s*(?:of|/)\s*{_D})?$"),
    re.compile(rf"^({_D})\s*/\s*{_D}$"),
    re.compile(rf"^第?\s*({_D})\s*页(?:\s*[,，/]?\s*共\s*{_D}\s*页)?$"),
    re.compile(rf"^[A-Za-z0-9]{{4}}\s+({_D})(?:\s+[A-Za-z0-9]{{2}}\s+{_D})$"),
)
_STYLE = re.compile(rf"(?<![A-Za-z]){_D}(?![A-Za-z])")
_SIDE = re.compile(rf"^({_D})(?:\s{{2,}}|\t)(?=\S)|(?:\s{{2,}}|\t)({_D})$")


def shape(word: str) -> str:
    """Letters a scan confuses, written alike: words of one shape are misreadings of each other."""
    return word.lower().translate(_ALIKE)


def page_number(line: str) -> int | None:
    """The number in a line that holds nothing but a page number."""
    t = line.strip()
    if not t or len(t) > 24:
        return None
    for form in PAGE_FORMS:
        m = form.match(t)
        if m and (n := m.group(1).translate(DIGIT_FOR)).isdigit():
            return int(n)
    return None


def bare_line(line: str) -> tuple[str, int | None]:
    """A running line without the page number at its side, and that number."""
    t = line.strip()
    m = _SIDE.search(t)
    if not m:
        return t, None
    n = (m.group(1) or m.group(2)).translate(DIGIT_FOR)
    return (t[: m.start()] + t[m.end() :]).strip(), int(n) if n.isdigit() else None


def template(line: str, names: Iterable[str]) -> str:
    """Shape of a running line, with the document's own names masked and digits alike."""
    s = shape(re.sub(r"(?<![A-Za-z0-9])[0-9OIlZSbB]*\d[0-9OIlZSbB]*(?:[.,][0-9OIlZSbB]+)*(?![A-Za-z0-9])", "#", bare_line(line)[0]))
    for name in names:
        if name:
            s = s.replace(shape(name), "@")
    return s


def furniture_like(t: str) -> bool:
    """Whether a template can be a running line: no sentence, no bare number, no page number."""
    return bool(t) and not re.search(r"[，。；！？]|[.;!?,]$|^(?:[^\w@]|[#_l])*$|^第\s*#\s*页|^pagc #", t)


def near(a: str, b: str, most: int) -> bool:
    """Edit distance of at most ``most`` (banded)."""
    if abs(len(a) - len(b)) > most:
        return False
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            row[j] = min(prev[j - 1] + (x != b[j - 1]), prev[j] + 1, row[j - 1] + 1)
        if min(row) > most:
            return False
        prev = row
    return prev[-1] <= most


def pages_of(text: str) -> list[list[str]]:
    return [p.split("\n") for p in re.split(r"\n[^\S\n]*\n", text.replace("\r\n", "\n").replace("\f", "\n\n"))]


def edge_lines(page: list[str]) -> list[tuple[int, int]]:
    """``(index, depth)`` of the lines near the top (depth 0, 1, ...) or foot (-1, -2, ...) of a page, whichever is nearer."""
    n = len(page)
    near_edge = [(i, i if i < n - i else i - n) for i in (range(n) if n <= 2 * EDGE else (*range(EDGE), *range(n - EDGE, n)))]
    return [(i, d) for i, d in near_edge if -EDGE <= d < EDGE]


def numbered_lines(pages: list[list[str]]) -> tuple[dict[tuple[int, int], tuple[int, int, str]], set[tuple[int, bool, str]]]:
    """Lines at page edges that may be page numbers, ``(page, line) -> (number, depth, style)``, and the sequences among them.

    A sequence is ``(number less page, at the top, style)`` that goes up with the pages: on two pages and half of them at least.
    """
    numbers: dict[tuple[int, int], tuple[int, int, str]] = {}
    for p, page in enumerate(pages):
        for i, depth in edge_lines(page):
            if (n := page_number(page[i])) is not None:
                numbers[p, i] = n, depth, _STYLE.sub("9", page[i].strip())
    steps = Counter((n - p, depth >= 0, style) for (p, _), (n, depth, style) in numbers.items())
    return numbers, {k for k, c in steps.items() if c >= 2 and c * 2 >= len(pages)}


def form_name(number: int, depth: int, style: str) -> str:
    """The form of a page number: its style, its side, and how many digits it has."""
    return f"#{int(depth >= 0)}|{len(str(number))}|{style}"


def forms_in_sequence(pages: list[list[str]]) -> set[str]:
    numbers, good = numbered_lines(pages)
    return {form_name(n, depth, style) for (p, _), (n, depth, style) in numbers.items() if (n - p, depth >= 0, style) in good}


def furniture(pages: list[list[str]], names: list[str], known: dict[str, bool]) -> dict[tuple[int, int], str]:
    """Running lines and page numbers: ``(page, line) -> "header" | "page_number"``.

    Page numbers are lines at a page edge that hold one and, in one style, go up with the pages. So are lines of the style of such
    a sequence on its side whose number is misread, and a line alone in a form that sequences of the corpus
    have (``known``): their style, their side, as many digits; a plain number only if it is 1, the last line of a single page. Running lines are edge lines whose shape, page number and misread
    letters apart, comes at the edges of three pages in ten, and two at least, or whose template the corpus knows as
    one (``known[template]``; false: it stands inside pages elsewhere, so it is body here too).
    Lines are taken from the edge inwards: a running line has none of the body outside it.
    """
    found: dict[tuple[int, int], str] = {}
    numbers, good = numbered_lines(pages)
    styles = {(top, style) for _, top, style in good}
    for (p, i), (n, depth, style) in numbers.items():
        page, plain = pages[p], pages[p][i].strip().isalnum()
        near_edge = -2 <= depth <= 1
        rises = (n - p, depth >= 0, style) in good or (len(page) <= 2 * EDGE and (n - p, depth < 0, style) in good)
        misread = not plain and near_edge and (depth >= 0, style) in styles
        usual = known.get(form_name(n, depth, style), False) and (near_edge if not plain else len(pages) == 1 and n == 1 and depth == -1 and len(page) > 1)
        if rises or misread or usual:
            found[p, i] = "page_number"
    shapes: dict[str, set[int]] = {}
    edges: list[tuple[int, int, int, str, str]] = []
    for p, page in enumerate(pages):
        for i, depth in edge_lines(page):
            if (p, i) not in found and page[i].strip() and not _BODY_MARK.search(page[i]):
                t = template(page[i], names)
                s = shape(bare_line(page[i])[0])
                shapes.setdefault(s, set()).add(p)
                edges.append((p, i, depth, t, s))
    often = {s for s, at in shapes.items() if len(at) >= max(2, 0.3 * len(pages))}
    often -= {s for _, _, _, t, s in edges if known.get(t) is False}
    for p, i, _, t, s in sorted(edges, key=lambda e: (e[0], min(e[1], len(pages[e[0]]) - 1 - e[1]))):
        page = pages[p]
        top, foot = range(i), range(i + 1, len(page))
        if not any(len(side) < EDGE and all((p, k) in found or not page[k].strip() for k in side) for side in (top, foot)):
            continue
        known_as = known.get(t)
        if known_as or (known_as is None and furniture_like(t) and (s in often or (len(s) >= 8 and any(near(s, o, 2) for o in often if abs(len(o) - len(s)) <= 2)))):
            found[p, i] = "header"
    return found


def body_lines(pages: list[list[str]], found: dict[tuple[int, int], str]) -> list[tuple[int, str]]:
    return [(p, line) for p, page in enumerate(pages) for i, line in enumerate(page) if (p, i) not in found and line.strip()]


def breaks_of(lines: list[tuple[int, str]]) -> list[tuple[int, str, str, str]]:
    """Words broken at a hyphen mark: (index of the line, left part, mark, right part)."""
    out = []
    for k in range(len(lines) - 1):
        a, b = lines[k][1].rstrip(), lines[k + 1][1].lstrip()
        if not a or a[-1] not in HYPHENS:
            continue
        left = re.search(r"[A-Za-z0-9]+(?:['’-][A-Za-z0-9]+)*$", a[:-1])
        right = re.match(r"[A-Za-z0-9]+(?:['’-][A-Za-z0-9]+)*", b)
        if left and right and re.search(r"[A-Za-z]", left.group()) and re.search(r"[A-Za-z]", right.group()):
            out.append((k, left.group(), a[-1], right.group()))
    return out


def fixed_number(token: str) -> str | None:
    """The number a misread token stands for, if it is one."""
    if not _NUMBERISH.fullmatch(token) or _CODE.fullmatch(token) or token.isdigit() or not re.search(r"[A-Za-z]", token):
        return None
    if not re.search(r"\d", token) and (len(token) == 1 or not re.fullmatch(r"[OIlZSbB.,]*[OIlZSB][OIlZSbB.,]*", token)):
        return None
    n = token.translate(DIGIT_FOR)
    return n if _NUMBER.fullmatch(n) else None


def may_be_number(low: str) -> bool:
    """Whether a token that reads ``low`` in lower case may be a misread number, in some letter case."""
    return bool(_NUMBERISH_LOW.fullmatch(low))


def words_of(line: str) -> list[str]:
    return [w for w in _WORD.findall(line) if len(w) <= 40]


def in_case(token: str, form: str, starts: bool) -> str:
    """``form`` (the vocabulary's usual writing) in the letter case of ``token``; ``starts``: it begins a sentence."""
    low = form.lower()
    letters = [c for c in token if c.isalpha() and c not in "Il"]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return low.upper()
    if starts or (token[0].isupper() and token[0] != "I"):
        return low[0].upper() + low[1:]
    if token[0].islower() and token[0] not in "lb":
        return low
    return form


def _names(row) -> list[str]:
    return [row.name_] if isinstance(row.name_, str) and row.name_.strip() else []


def _count_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    words: Counter = Counter()
    docs: Counter = Counter()
    edge: Counter = Counter()
    inner: Counter = Counter()
    sequences: Counter = Counter()
    readings: Counter = Counter()
    for row in pdf.itertuples():
        if not row.text_:
            continue
        names, here = _names(row), set()
        pages = pages_of(row.text_)
        sequences.update(forms_in_sequence(pages))
        for page in pages:
            edges = {i for i, depth in edge_lines(page) if -2 <= depth <= 1}
            for i, line in enumerate(page):
                if _HAS_LETTER.search(line) or _READING.search(line):
                    for w in words_of(line):
                        if w.isalpha():
                            words[w] += 1
                        elif w.isdigit():
                            if _READING.fullmatch(w):
                                readings[w] += 1
                        elif "-" in w and w.replace("-", "").isalpha():
                            words[w] += 1
                            words.update(w.split("-"))
                if len(line) <= LONGEST and not _BODY_MARK.search(line) and line.strip() and furniture_like(t := template(line, names)):
                    if i in edges:
                        here.add(t)
                        edge[t] += 1
                    else:
                        inner[t] += 1
        docs.update(here)
    rows = [("w", w, shape(w), n, 0, 0) for w, n in words.items() if w]
    rows += [("t", t, "", docs[t], edge[t], inner[t]) for t in edge.keys() | inner.keys()]
    rows += [("q", q, "", n, 0, 0) for q, n in sequences.items()] + [("n", x, "", n, 0, 0) for x, n in readings.items()]
    return pd.DataFrame(rows, columns=["kind", "key", "shape", "n", "edge", "inner"])


def _analyse(row, known: dict[str, bool]) -> tuple[list[list[str]], dict[tuple[int, int], str], list[tuple[int, str]], list[tuple[int, str, str, str]]]:
    pages = pages_of(row.text_)
    found = furniture(pages, _names(row), known)
    lines = body_lines(pages, found)
    return pages, found, lines, breaks_of(lines)


def _suspects(lines: list[tuple[int, str]], breaks: list[tuple[int, str, str, str]], common: frozenset[str]) -> Iterator[tuple[str, bool]]:
    """(token, whether it begins a sentence) of the tokens with letters that ``common`` doesn't hold, halves of broken words left out."""
    ends, begins = {k for k, *_ in breaks}, {k + 1 for k, *_ in breaks}
    for k, (_, line) in enumerate(lines):
        if not _HAS_LETTER.search(line):
            continue
        found = [m for m in _WORD.finditer(line) if not m.group().isdigit() and m.group().lower() not in common]
        if not found:
            continue
        spans = [m.span() for m in _WORD.finditer(line)] if k in ends or k in begins else []
        for m in found:
            w = m.group()
            if len(w) > 40 or not _HAS_LETTER.search(w) or (spans and ((k in ends and m.span() == spans[-1]) or (k in begins and m.span() == spans[0]))):
                continue
            before = line[: m.start()].strip() or (lines[k - 1][1] if k else "")
            yield w, not before or bool(_SENTENCE_END.search(before))


def _edge_keys(row) -> set[str]:
    """What of a text is looked up in the corpus: templates of its edge lines, and forms of what may be page numbers."""
    pages, names = pages_of(row.text_), _names(row)
    keys = {template(page[i], names) for page in pages for i, _ in edge_lines(page) if page[i].strip()}
    return keys | {form_name(*number) for number in numbered_lines(pages)[0].values()}


def _with_known(src: DataFrame, stats: DataFrame) -> DataFrame:
    """``src`` with known_ and values_, what ``stats`` (key, running) holds of each text's edge lines; one row per text is its bound."""
    kind = src.schema["key_"].dataType.simpleString()
    src = src.withColumn("_t", F.xxhash64("text_", "name_"))

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(row.key_, row.t_, k) for row in pdf.rename(columns={"_t": "t_"}).itertuples() for k in _edge_keys(row)]
            yield pd.DataFrame(rows, columns=["_k", "_h", "key"])

    per = src.mapInPandas(edges, f"_k {kind}, _h bigint, key string").distinct().join(stats, "key")
    per = per.groupBy("_k", "_h").agg(F.collect_list(F.struct("key", "running")).alias("_s"))
    out = src.join(per, src["key_"].eqNullSafe(per["_k"]) & (src["_t"] == per["_h"]), "left")
    got = F.coalesce("_s", F.array().cast("array<struct<key:string,running:boolean>>"))
    return out.select("key_", "name_", "text_", F.transform(got, lambda x: x["key"]).alias("known_"), F.transform(got, lambda x: x["running"]).alias("values_"))


def _find_batch(pdf: pd.DataFrame, known: list[dict[str, bool]], common: frozenset[str]) -> pd.DataFrame:
    out = []
    for row, here in zip(pdf.itertuples(), known, strict=True):
        pages, found, lines, breaks = _analyse(row, here)
        seen = {(k, pages[p][i].strip(), "", "", "", "") for (p, i), k in found.items()}
        for _, a, mark, b in breaks:
            seen.add(("hyphen", a + b, a + "-" + b, a + mark + " " + b, (a + b).lower(), (a + "-" + b).lower()))
        for w, starts in _suspects(lines, breaks, common):
            if (n := fixed_number(w)) and (_HAS_DIGIT.search(w) or not w.isupper()):
                seen.add(("misread", n, "", w, "", ""))
            elif n:  # capitals alone: a number only if the corpus has it far more often than the word
                seen.add(("letters", n, "", w, w.lower(), ""))
            elif not _CODE.fullmatch(w):
                seen.add(("word", w, "1" if starts else "", w, w.lower(), shape(w)))
        out += [(row.key_, *x) for x in seen]
    return pd.DataFrame(out, columns=["key_", "kind", "item", "other", "raw", "a", "b"])


def damage(
    texts: DataFrame, *, key: str, text: str, name: str, min_docs: int = 5, common_words: int = 20_000, max_broadcast: int = 200_000, ratio: int = 20
) -> DataFrame:
    """What scanning damaged in each text: (key, kind, item, raw), each once.

    ``kind`` is header, page_number (``item`` the trimmed line), hyphen (the word as it must read; ``raw`` the two
    halves and their mark) or misread (the right form; ``raw`` the token as it stands). ``name`` is a column with the
    name of the text's subject, which running lines often carry; it may be null.

    1. One pass counts, over all texts, words and the templates of lines at page edges and inside pages; the
       partial counts of a batch are summed before the shuffle.
    2. Templates seen at page edges of at least ``min_docs`` texts and at most a fifth as often inside pages are
       running lines wherever they stand at an edge; those seen inside half as often, or more, are body. The others are
       decided within each text by fuzzy repetition at its page edges, as are lines of more than ``LONGEST`` characters. Up to ``max_broadcast`` such templates go to the
       workers; more are joined with the edge lines of each text instead, with the same result.
    3. A second pass takes running lines and page numbers out, lists broken words and suspect tokens. Both are
       settled by joins with the vocabulary: a broken word reads as its joined or its hyphenated form, whichever
       the corpus holds more often (joined, if neither); a token is misread if the most frequent word of its shape is
       at least ``ratio`` times as frequent, or if it mixes digits into a word of the vocabulary; numbers with letters
       in place of digits need no vocabulary, but of capitals alone (ISO, SOO) only those are numbers that the corpus
       holds, read so, ``ratio`` times as often as the word. ``common_words`` words are known to the workers, only to spare joins.

    Null, empty and blank texts have no damage; repeated rows give their damage once; other columns are ignored.
    """
    spark = texts.sparkSession
    sc = spark.sparkContext
    src = texts.select(F.col(key).alias("key_"), F.col(name).cast("string").alias("name_"), F.col(text).alias("text_")).where(F.trim("text_") != "")
    kind_of_key = src.schema["key_"].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _count_batch(pdf)

    counts = src.mapInPandas(count, "kind string, key string, shape string, n bigint, edge bigint, inner bigint")
    counts = written(counts.groupBy("kind", "key", "shape").agg(F.sum("n").alias("n"), F.sum("edge").alias("edge"), F.sum("inner").alias("inner")), "scan-counts")
    rare, common = F.col("inner") * 5 <= F.col("edge"), F.col("inner") * 2 >= F.col("edge")
    stats = counts.where((F.col("kind") == "t") & (F.col("n") >= min_docs) & (rare | common)).select("key", rare.alias("running"))
    stats = stats.unionByName(counts.where((F.col("kind") == "q") & (F.col("n") >= min_docs)).select("key", F.lit(True).alias("running")))
    few = stats.limit(max_broadcast + 1).collect()
    words = counts.where(F.col("kind") == "w").select("key", F.lower("key").alias("low"), F.lower("shape").alias("shape"), "n")
    lows = words.groupBy("low", "shape").agg(F.sum("n").alias("n"), F.max(F.struct("n", "key"))["key"].alias("form"))
    best = lows.groupBy("shape").agg(F.max(F.struct("n", "low", "form")).alias("b")).select("shape", F.col("b.n").alias("best_n"), F.col("b.low").alias("best"), F.col("b.form").alias("form"))
    usual = best.orderBy(F.desc("best_n"), "best").limit(common_words).select("best").collect()
    joined = len(few) > max_broadcast
    known_b = sc.broadcast({} if joined else {r.key: r.running for r in few})
    if joined:
        src = _with_known(src, stats)
    usual_b = sc.broadcast(frozenset(r.best for r in usual if not may_be_number(r.best)))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = [dict(zip(k, v, strict=True)) for k, v in zip(pdf["known_"], pdf["values_"], strict=True)] if joined else [known_b.value] * len(pdf)
            yield _find_batch(pdf, known, usual_b.value)

    cases = written(src.mapInPandas(find, f"key_ {kind_of_key}, kind string, item string, other string, raw string, a string, b string"), "scan-cases")
    plain = cases.where(F.col("kind").isin("header", "page_number", "misread")).select("key_", "kind", "item", "raw")
    forms = lows.groupBy("low").agg(F.sum("n").alias("n"))
    by = lambda c, n: forms.select(F.col("low").alias(c), F.col("n").alias(n))
    broken = cases.where(F.col("kind") == "hyphen").join(by("a", "n_joined"), "a", "left").join(by("b", "n_kept"), "b", "left")
    kept = F.coalesce("n_kept", F.lit(0)) > F.coalesce("n_joined", F.lit(0))
    broken = broken.select("key_", "kind", F.when(kept, F.col("other")).otherwise(F.col("item")).alias("item"), "raw")
    read = counts.where(F.col("kind") == "n").select(F.col("key").alias("item"), F.col("n").alias("n_read"))
    capitals = cases.where(F.col("kind") == "letters").join(read, "item").join(by("a", "n_word"), "a", "left")
    capitals = capitals.where(F.col("n_read") >= ratio * F.coalesce("n_word", F.lit(1))).select("key_", F.lit("misread").alias("kind"), "item", "raw")
    odd = cases.where(F.col("kind") == "word").withColumnRenamed("b", "shape").join(best, "shape").join(by("a", "own"), "a", "left")
    own = F.coalesce("own", F.lit(0))
    mixed = F.col("raw").rlike("[0-9]")
    odd = odd.where((F.col("best") != F.col("a")) & ((mixed & (F.col("best_n") >= 2)) | (F.col("best_n") >= ratio * F.greatest(own, F.lit(1)))))

    def cased(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            items = [in_case(r.raw, r.form, r.other == "1") for r in pdf.itertuples()]
            yield pd.DataFrame({"key_": pdf["key_"], "kind": "misread", "item": items, "raw": pdf["raw"]})

    odd = odd.select("key_", "raw", "form", "other").mapInPandas(cased, f"key_ {kind_of_key}, kind string, item string, raw string")
    every = plain.unionByName(broken).unionByName(odd).unionByName(capitals)
    return every.dropDuplicates(["key_", "kind", "item", "raw"]).withColumnRenamed("key_", key)


def _rebuilt(row, fixes: dict[str, str]) -> str:
    """The text as continuous paragraphs, with the damage of ``fixes`` ("kind|raw" -> item) mended."""
    pages = pages_of(row.text_)
    gone = {r for k, r in ((x.split("|", 1)) for x in fixes) if k in ("header", "page_number")}
    lines = []
    for page in pages:
        edges = {i for i, _ in edge_lines(page)}
        lines += [(0, line) for i, line in enumerate(page) if line.strip() and not (i in edges and line.strip() in gone)]
    breaks = {k: (a, mark, b) for k, a, mark, b in breaks_of(lines)}
    terminal = re.compile(r"[。！？；.!?:：][\"'”’）)]*\s*$")
    open_ended = sum(not terminal.search(line) for _, line in lines)
    wrapped = bool(gone or breaks) or open_ended * 2 > len(lines)
    width = max((len(line) for _, line in lines), default=0)
    out, pending = [], ""
    for k, (_, line) in enumerate(lines):
        line = _WORD.sub(lambda m: fixes.get("misread|" + m.group(), m.group()), line.strip())
        if k - 1 in breaks:
            a, mark, b = breaks[k - 1]
            word = fixes.get(f"hyphen|{a}{mark} {b}", a + b)
            head = pending.rstrip()
            pending = head[: len(head) - len(a) - 1] + word + line[len(b) :]
        elif pending:
            glue = " " if pending[-1].isascii() and line[:1].isascii() else ""
            pending = pending.rstrip() + glue + line
        else:
            pending = line
        ends = terminal.search(line) and len(line) < 0.95 * width
        if not wrapped or (k not in breaks and (ends or re.fullmatch(r"\S{0,24}(?: \w+){0,3}\s*[\d,.]+|(?:单位|Unit).*", line))):
            out.append(pending)
            pending = ""
    return "\n".join(out + [pending] * bool(pending))


def repair_texts(texts: DataFrame, *, key: str, text: str, name: str, **options) -> DataFrame:
    """(key, text) of every row with a text: paragraphs without running lines, page numbers, broken and misread words.

    Null, empty and blank texts come out as they are. ``key`` should be unique; of equal keys with different texts
    each is repaired with the damage of both. Shuffles the texts once, to meet their list of damage.
    """
    found = damage(texts, key=key, text=text, name=name, **options)
    fixes = found.select(F.col(key).alias("key_"), F.concat_ws("|", "kind", F.when(F.col("kind").isin("header", "page_number"), F.col("item")).otherwise(F.col("raw"))).alias("k"), "item")
    fixes = fixes.dropDuplicates(["key_", "k"]).groupBy("key_").agg(F.collect_list("k").alias("ks"), F.collect_list("item").alias("items"))
    src = texts.select(F.col(key).alias("key_"), F.col(text).alias("text_")).join(fixes, "key_", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for row in pdf.itertuples():
                if not row.text_ or not row.text_.strip():
                    done.append(row.text_)
                    continue
                done.append(_rebuilt(row, dict(zip(row.ks, row.items, strict=True)) if row.ks is not None else {}))
            yield pd.DataFrame({"key_": pdf["key_"], "text_": done})

    kind = src.schema["key_"].dataType.simpleString()
    return src.mapInPandas(run, f"key_ {kind}, text_ string").withColumnsRenamed({"key_": key, "text_": text})
