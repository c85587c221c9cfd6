"""Repair of text from scanned pages (problem 2).

Running headers, footers and page numbers are recognised at the edges of the
pages of one file. The rest gives a lexicon with frequencies and bigrams. Words
that the lexicon doesn't vouch for are looked up in a symmetric-delete index
over it; a weighted edit distance in which common confusions of characters are
cheap ranks the candidates, and the bigrams with the neighbouring words pick
one. Words cut at a line's end are joined unless the break mark belongs to
their spelling.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirebase.session import materialise, scratch_dir

#: Marks that may break a word at a line's end.
BREAKS = "-¬­‐‑‒–⁃−﹣－"
#: What is read for what, beside digits for letters.
CONFUSED = {
    "rn": "m", "ri": "n", "ii": "u", "cl": "d", "vv": "w", "\\/": "v", "li": "h", "nn": "m",
    "0": "o", "1": "li", "5": "s", "9": "g", "6": "b", "8": "b", "2": "z", "3": "e", "4": "a", "7": "t",
    "!": "il", "|": "il", "@": "a", "+": "t", "(": "c", "[": "l", "$": "s", "{": "c", "}": "j", "<": "c", "€": "e",
    "c": "eo", "e": "co", "o": "ec0", "b": "h", "h": "b", "v": "y", "y": "v", "u": "ii", "i": "lj", "l": "it", "t": "lf", "f": "t", "q": "g", "g": "q", "j": "i", "ı": "i",
}
#: Single characters read for two.
MERGED = {"m": "rn", "u": "ll", "w": "vv", "d": "cl", "n": "ri", "h": "li", "ﬁ": "fi", "ﬂ": "fl"}
_ROMAN = re.compile(r"^(?=.)x{0,3}(ix|iv|v?i{0,3})$")
_LETTERS = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_NUMERIC = re.compile(r"[\W_]*\d[\d.,:/%°±()\-]*[\W_]*|[^\w]*")
_LEFT, _RIGHT = "\"'“”‘’„«»([{<*•·", ".,;:?!\"'“”‘’»«)]}>*"
_NUMBER = r"(?:[0-9lIOoSBZ|!]{1,5}|[ivxlcIVXLC1!|]{1,8})"
_PAGE_NUMBER = re.compile(rf"^[\W_]*(?:(?P<word>[Pp][^\W\d_]{{0,3}}\.?)\s*)?(?P<n>{_NUMBER})(?:\s*(?:of|/|0f|ot)\s*{_NUMBER})?[\W_]*$")
_TITLE_PAGE = re.compile(rf"^(?P<title>.*[^\W\d_].*),\s*[Pp]\.?\s*(?P<n>{_NUMBER})$")
_NUMBER_GAP = re.compile(rf"^(?:(?P<a>{_NUMBER})\s{{2,}}(?P<t>\S.*[^\W\d_].*)|(?P<u>\S.*[^\W\d_].*?)\s{{2,}}(?P<b>{_NUMBER}))$")
_CAPTION = re.compile(r"^\S+\s+\d+(\.\d+)*[.:]?(\s|$)")
_LISTED = re.compile(r"^([\divxl]+[.)]|[•*·-])\s")


#: The filter of tokens that may need a repair has 2 to the power of it bits (2 MB), merged in blocks of so many bytes.
FILTER_BITS, _BLOCK = 24, 1 << 15


#: Cost of a repair of what the lexicon has as a word, at most.
DEAREST_OF_A_WORD = 0.5


@dataclass(frozen=True)
class ScanParams:
    seen: int = 5  # times a word must occur to be a candidate
    ratio: float = 8.0  # times that a candidate must be as frequent as what was read
    letters_ratio: float = 20.0  # the same where all that was read is letters
    dearest: float = 0.9  # cost of a repair, at most
    longest: int = 40  # letters of a word that is looked up
    pages: int = 512  # of one file that are compared for running lines at a time
    running: int = 200  # characters of a running line, at most; a longer line is text


def _skeleton(line: str) -> str:
    """A line without what scanning confuses: one sign for each group of look-alikes."""
    s = re.sub(r"\d+\s*$|^\s*\d+", "", line.lower())
    for wrong, right in (("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"), ("\\/", "v")):
        s = s.replace(wrong, right)
    return re.sub(r"[^a-z0-9]", "", s.translate(str.maketrans("c(eo03v!1|5@+9q8h6", "ooooooyllisatggbbb"))).replace("i", "l")


def _within(a: str, b: str, most: int) -> bool:
    """Whether few replacements, or a plain edit, make one of the other."""
    if abs(len(a) - len(b)) > most:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= most
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= most


def _value(n: str) -> tuple[str, int] | None:
    roman = n.lower().translate(str.maketrans("1!|", "iii"))
    if _ROMAN.match(roman) and not (n.isdigit() or n in ("l", "I")):
        total, before = 0, 0
        for c in reversed(roman):
            v = {"i": 1, "v": 5, "x": 10}[c]
            total, before = total + (v if v >= before else -v), max(v, before)
        return "roman", total
    digits = n.translate(str.maketrans("lIOoSBZ|!", "110058211"))
    return ("arabic", int(digits)) if digits.isdigit() else None


def _furniture(group: pa.Table) -> pa.Table:
    """The running lines and page numbers among the edge lines of one file's pages."""
    rows = sorted(zip(group.column("page_no").to_pylist(), group.column("line_no").to_pylist(), group.column("line").to_pylist(), group.column("top").to_pylist(), group.column("width").to_pylist(), group.column("after").to_pylist()))
    numbered, plain, out = [], [], set()
    for page, no, line, top, width, after in rows:
        s = line.strip()
        if m := _PAGE_NUMBER.match(s):
            if v := _value(m["n"]):
                numbered.append((page, no, v, bool(m["word"]) or not s[:1].isalnum() or " of " in s, s))
            continue
        if m := _TITLE_PAGE.match(s):
            out.add((page, no))
            continue
        if (m := _NUMBER_GAP.match(s)) and _value(m["a"] or m["b"]):
            out.add((page, no))
            continue
        plain.append((page, no, s, top, width, after))
    # printed numbers rise by one a page, or by two where every other page was scanned
    offsets = Counter((v[0], rise, v[1] - rise * page) for page, _, v, _, _ in numbered for rise in (1, 2))
    for page, no, v, marked, s in numbered:
        if marked or v[0] == "roman" or any(offsets[v[0], rise, v[1] - rise * page] > 1 for rise in (1, 2)) or len(numbered) == 1:
            out.add((page, no))
    kept = []
    for page, no, s, top, width, after in plain:
        if s.endswith((".", ",", ";", ":", "?", "-", '"')) or _LISTED.match(s) or len(s) > 0.95 * width and " | " not in s or not s[:1].isupper() and not s[:1].isdigit():
            continue
        if _CAPTION.match(s) and " | " not in s and not re.match(r"^[A-Z]{2,4} ?\d{3}$", s):
            continue
        kept.append((page, no, s, top, width, after, _skeleton(s)))
    forms: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for *_, top, _, _, sk in kept:
        forms[top][sk] += 1
    for page, no, s, top, width, after, sk in kept:
        often = sum(n for f, n in forms[top].items() if f == sk or _within(f, sk, 2))
        if " | " in s or often > 1 and len(s) < 0.8 * width or top and (s.isupper() or len(s) < 0.6 * width and len(s.split()) <= 6 and not re.search(r"(?<!\w)\d", s)):
            out.add((page, no))
    done = sorted(out)
    name = group.column("file_hash")[0].as_py()
    return pa.table({"file_hash": pa.array([name] * len(done), pa.string()), "page_no": pa.array([p for p, _ in done], pa.int32()), "line_no": pa.array([n for _, n in done], pa.int32())})


def _plain(token: str) -> str:
    return token.lstrip(_LEFT).rstrip(_RIGHT).lower().replace("’", "'")


def _cut(token: str) -> bool:
    """Whether a line's last token may be the first part of a word."""
    return len(token) > 1 and token[-1] in BREAKS and token[-2] not in " \t" and any(c.isalpha() for c in token)


def _units(line: str, before: str | None, after: str | None) -> Iterator[tuple[str, str, str | None]]:
    """(what, token, continuation): 'word', or 'cut' for a last token with the next line's first; a part of the line before's cut isn't given again."""
    tokens = line.split()
    if before and tokens and (b := before.split()) and _cut(b[-1]):
        tokens = tokens[1:]
    for k, token in enumerate(tokens):
        if k == len(tokens) - 1 and _cut(token):
            yield "cut", token, (after.split() or [""])[0] if after else ""
        else:
            yield "word", token, None


_SCHEMA = pa.schema([("kind", pa.string()), ("first", pa.string()), ("second", pa.string()), ("times", pa.int64())])


def _count_words(params: ScanParams):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(counts: Counter) -> pa.RecordBatch:
            keys = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([k[2] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())], schema=_SCHEMA)

        counts: Counter = Counter()
        for batch in batches:
            for line, before, after in zip(*(batch.column(c).to_pylist() for c in ("line", "before", "after"))):
                last = ""
                for what, token, more in _units(line, before, after):
                    if what == "cut":
                        counts["cut", token, more] += 1
                        continue
                    word = _plain(token)
                    counts["token", token, ""] += 1
                    counts["word", word, ""] += 1
                    if last and word:
                        counts["bigram", last, word] += 1
                    last = word
            if len(counts) > 300_000:
                yield emit(counts)
                counts = Counter()
        if counts:
            yield emit(counts)

    return count


def _deletes(word: str) -> set[str]:
    """The word with up to two characters left out."""
    out = {word}
    for n in (1, 2):
        if len(word) > n + 1:
            for at in combinations(range(len(word)), n):
                out.add("".join(c for k, c in enumerate(word) if k not in at))
    return out


def cost(read: str, word: str) -> float:
    """Weighted edit distance: 0.25 for a known confusion, 0.5 for another sign in a letter's place, 1 for any other edit."""
    n, m = len(read), len(word)
    table = [[math.inf] * (m + 1) for _ in range(n + 1)]
    table[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            here = table[i][j]
            if here > 1.5:
                continue
            if i < n and j < m:
                a, b = read[i], word[j]
                step = 0.0 if a == b else 0.25 if b in CONFUSED.get(a, "") else 0.5 if not a.isalpha() and b.isalpha() else 1.0
                table[i + 1][j + 1] = min(table[i + 1][j + 1], here + step)
                if i + 1 < n and b in CONFUSED.get(read[i : i + 2], ""):
                    table[i + 2][j + 1] = min(table[i + 2][j + 1], here + 0.25)
            if i < n and word[j : j + 2] == MERGED.get(read[i], "-"):
                table[i + 1][j + 2] = min(table[i + 1][j + 2], here + 0.25)
            if i < n:
                table[i + 1][j] = min(table[i + 1][j], here + 1)
            if j < m:
                table[i][j + 1] = min(table[i][j + 1], here + 1)
    return table[n][m]


def _readings(token: str, longest: int) -> set[str]:
    """Forms under which a token is looked up, with two-character confusions undone."""
    forms = {_plain(token), token.lower().rstrip(",.;:?\"'”’)]}"), token.lower().lstrip("\"'“‘([{").rstrip(",.;:"), token.lower()}
    out = set()
    for form in forms:
        if 3 <= len(form) <= longest and any(c.isalpha() for c in form) and not _NUMERIC.fullmatch(form):
            out.add(form)
            for pair in ("rn", "ri", "ii", "cl", "vv", "\\/", "li"):
                if pair in form:
                    out.add(form.replace(pair, CONFUSED[pair]))
    return out


def _lookups(params: ScanParams):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, times, part = [], [], []
            for t, n in zip(batch.column("token").to_pylist(), batch.column("times").to_pylist()):
                for p in {d for form in _readings(t, params.longest) for d in _deletes(form)}:
                    token.append(t)
                    times.append(n)
                    part.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.string()), pa.array(times, pa.int64()), pa.array(part, pa.string())], ["token", "times", "part"])

    return look


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, often, part = [], [], []
        for w, n in zip(batch.column("word").to_pylist(), batch.column("often").to_pylist()):
            for p in _deletes(w):
                word.append(w)
                often.append(n)
                part.append(p)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(often, pa.int64()), pa.array(part, pa.string())], ["word", "often", "part"])


def _rank(params: ScanParams):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, costs = [], []
            for k, (token, times, word, often) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("token", "times", "word", "often")))):
                forms = {_plain(token), token.lower().rstrip(",.;:?\"'”’)]}"), token.lower().lstrip("\"'“‘([{").rstrip(",.;:"), token.lower()}
                if word in forms:
                    keep.append(k)
                    costs.append(0.0)
                    continue
                c = min(cost(f, word) for f in forms)
                ratio = params.letters_ratio if _LETTERS.fullmatch(_plain(token)) else params.ratio
                if c <= params.dearest and often >= ratio * times:
                    keep.append(k)
                    costs.append(c)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("token").take(at), batch.column("word").take(at), batch.column("often").take(at), pa.array(costs, pa.float64())], ["token", "word", "often", "cost"])

    return rank


@dataclass(frozen=True)
class Repairs:
    lines: DataFrame  # body lines: file_hash, page_no, line_no, line, before, after
    furniture: DataFrame  # file_hash, page_no, line_no
    words: DataFrame  # token, word, often, cost: candidates of every token that may be misread; own, own_often: what the lexicon has of it as read
    cuts: DataFrame  # first, second, own (the mark belongs to the word), misread, word
    bigrams: DataFrame  # first, second, times


def analyse(pages: DataFrame, params: ScanParams = ScanParams()) -> Repairs:
    """Everything that repairing needs, over all pages.

    ``pages`` needs file_hash, page_no and text. Rows with a null in one of
    them are left out, repeated rows count once, of differing texts under one
    page the least holds; blank pages have no lines.
    """
    spark = pages.sparkSession
    base = scratch_dir(spark)
    page = ["file_hash", "page_no"]
    texts = pages.where("file_hash is not null and page_no is not null and text is not null").groupBy("file_hash", F.col("page_no").cast("int").alias("page_no")).agg(F.min("text").alias("text"))
    lines = texts.select(*page, F.posexplode(F.split("text", "\n")).alias("at", "line")).select(*page, (F.col("at") + 1).alias("line_no"), "line").where(F.col("line").rlike(r"\S"))
    lines = materialise(lines, f"{base}/lines")
    extent = lines.groupBy(*page).agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"))
    width = lines.groupBy("file_hash").agg(F.expr("percentile_approx(length(line), 0.9)").alias("width"))
    edges = lines.join(extent, page).where((F.col("line_no") == F.col("first")) | (F.col("line_no") == F.col("last"))).where(F.length("line") <= params.running).join(width, "file_hash").select(*page, "line_no", "line", (F.col("line_no") == F.col("first")).alias("top"), "width", F.lit(0).alias("after"), F.floor(F.col("page_no") / params.pages).alias("stretch"))
    furniture = materialise(edges.groupBy("file_hash", "stretch").applyInArrow(_furniture, "file_hash string, page_no int, line_no int"), f"{base}/furniture")
    order = Window.partitionBy("file_hash").orderBy("page_no", "line_no")
    body = lines.join(furniture, [*page, "line_no"], "left_anti").withColumn("before", F.lag("line").over(order)).withColumn("after", F.lead("line").over(order))
    body = materialise(body.select(*page, "line_no", "line", "before", "after"), f"{base}/body")
    counted = materialise(body.select("line", "before", "after").mapInArrow(_count_words(params), "kind string, first string, second string, times bigint").groupBy("kind", "first", "second").agg(F.sum("times").alias("times")), f"{base}/counted")
    words = counted.where("kind = 'word'").select(F.col("first").alias("word"), F.col("times").alias("often")).where(F.col("word").rlike(r"^[^\W\d_]+([-'][^\W\d_]+)*$") & (F.length("word") > 1))
    candidates = words.where(F.col("often") >= params.seen).where(F.length("word") <= params.longest)
    tokens = counted.where("kind = 'token'").select(F.col("first").alias("token"), "times")
    cuts = counted.where("kind = 'cut'").select("first", "second", "times")
    joined = cuts.select(F.concat(F.expr("substring(first, 1, length(first) - 1)"), "second").alias("token"), "times").groupBy("token").agg(F.sum("times").alias("times"))
    asked = tokens.unionByName(joined.where("token <> ''")).groupBy("token").agg(F.sum("times").alias("times"))
    looked = asked.mapInArrow(_lookups(params), "token string, times bigint, part string")
    index = candidates.mapInArrow(_index, "word string, often bigint, part string")
    near = looked.join(index, "part").select("token", "times", "word", "often").distinct()
    ranked = materialise(near.mapInArrow(_rank(params), "token string, word string, often bigint, cost double"), f"{base}/ranked")
    # what is a word itself stays, unless a far more frequent one is a confusion away
    fine = ranked.where("cost = 0").groupBy("token").agg(F.max("often").alias("own_often"), F.max_by("word", "often").alias("own"))
    misread = (
        ranked.where("cost > 0").join(fine, "token", "left")
        .where(F.col("own_often").isNull() | ((F.col("cost") <= DEAREST_OF_A_WORD) & (F.col("often") >= params.letters_ratio * F.col("own_often"))))
        .select("token", "word", "often", "cost", "own", "own_often")
    )
    misread = materialise(misread, f"{base}/misread")
    spelled = cuts.withColumn("joined", F.concat(F.expr("substring(first, 1, length(first) - 1)"), "second")).withColumn("marked", F.concat(F.expr("substring(first, 1, length(first) - 1)"), F.lit("-"), "second"))
    clean = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"""^["'“‘(\[]+""", ""), r"""[.,;:?!"'”’)\]]+$""", ""))
    lexicon = words.select(F.col("word"), "often")
    spelled = (
        spelled.withColumn("as_joined", clean(F.col("joined"))).withColumn("as_marked", clean(F.col("marked")))
        .join(lexicon.select(F.col("word").alias("as_joined"), F.col("often").alias("joined_often")), "as_joined", "left")
        .join(lexicon.select(F.col("word").alias("as_marked"), F.col("often").alias("marked_often")), "as_marked", "left")
    )
    best = misread.groupBy("token").agg(F.min_by("word", F.struct("cost", -F.col("often"))).alias("word"))
    spelled = spelled.join(best.select(F.col("token").alias("joined"), "word"), "joined", "left").select(
        "first", "second", "joined", (F.coalesce("marked_often", F.lit(0)) > F.coalesce("joined_often", F.lit(0))).alias("own"), F.col("word").isNotNull().alias("misread"), "word"
    )
    bigrams = counted.where("kind = 'bigram'").select("first", "second", "times")
    return Repairs(body, furniture, misread, materialise(spelled, f"{base}/cuts"), bigrams)


def _bit(token: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(token) >> (64 - FILTER_BITS)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits of tokens, in blocks of the filter."""
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for batch in batches:
        for token in batch.column("token").to_pylist():
            at = _bit(token)
            bits[at >> 3] |= 1 << (at & 7)
    blocks = bits.reshape(-1, _BLOCK)
    some = np.flatnonzero(blocks.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[k].tobytes() for k in some], pa.binary())], ["block", "bits"])


def _either(group: pa.Table) -> pa.Table:
    total = np.zeros(_BLOCK, np.uint8)
    for b in group.column("bits"):
        total |= np.frombuffer(b.as_py(), np.uint8)
    return pa.table({"block": group.column("block").slice(0, 1), "bits": pa.array([total.tobytes()], pa.binary())})


def token_filter(tokens: DataFrame):
    """A filter of fixed size that every one of the tokens passes, for all tasks; the rare other that passes is told off in a join."""
    spark = tokens.sparkSession
    blocks = tokens.select("token").mapInArrow(_mark, "block int, bits binary").groupBy("block").applyInArrow(_either, "block int, bits binary").toArrow()
    filled = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for block, bits in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        filled[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(bits, np.uint8)
    return spark.sparkContext.broadcast(filled.tobytes())


def _occurrences(wanted):
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The units that may need a repair, and cuts, with their neighbours' words."""
        passes: dict[str, bool] = {}
        for batch in batches:
            yield _asked(batch, wanted.value, passes)

    return occurrences


def _asked(batch: pa.RecordBatch, bits: bytes, passes: dict[str, bool]) -> pa.RecordBatch:
    names = ["file_hash", "page_no", "line_no", "what", "token", "second", "left", "right"]
    out: list[list] = [[] for _ in names]
    for f, p, n, line, before, after in zip(*(batch.column(c).to_pylist() for c in ("file_hash", "page_no", "line_no", "line", "before", "after"))):
        units = list(_units(line, before, after))
        for k, (what, token, second) in enumerate(units):
            if what == "word":
                asked = passes.get(token)
                if asked is None:
                    if len(passes) > 500_000:
                        passes.clear()
                    at = _bit(token)
                    asked = passes[token] = bool(bits[at >> 3] >> (at & 7) & 1)
                if not asked:
                    continue
            near = (_plain(units[k - 1][1]) if k else "", _plain(units[k + 1][1]) if k + 1 < len(units) else "")
            for column, value in zip(out, (f, p, n, what, token, second, *near)):
                column.append(value)
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)


_UNIT = "file_hash string, page_no int, line_no int, what string, token string, second string, left string, right string"


def _wrong_part(first: F.Column, word: F.Column, second: F.Column) -> F.Column:
    """Whether the part before the break differs from the repaired word's beginning; the same of the part after it."""
    head = F.lower(F.regexp_replace(F.expr("substring(first, 1, length(first) - 1)"), r"""^["'“‘(\[]+""", ""))
    return ~F.startswith(word, head)


def line_findings(pages: DataFrame, params: ScanParams = ScanParams()) -> DataFrame:
    """(file_hash, page_no, line_no, kind) of each line that is furniture, is cut at its end, or holds a misread word."""
    r = analyse(pages, params)
    key = ["file_hash", "page_no", "line_no"]
    units = materialise(r.lines.mapInArrow(_occurrences(token_filter(r.words)), _UNIT), f"{scratch_dir(pages.sparkSession)}/units")
    misread = _picked(units, r, key).where("word is not null").select(*key, F.lit("misread").alias("kind"))
    cut = units.where("what = 'cut'").select(*key, F.col("token").alias("first"), "second").join(r.cuts, ["first", "second"])
    hyphen = cut.where("not own").select(*key, F.lit("hyphen").alias("kind"))
    wrong = cut.where("misread and not own")
    order = Window.partitionBy("file_hash").orderBy("page_no", "line_no")
    following = r.lines.select(*key, F.lead("page_no").over(order).alias("next_page"), F.lead("line_no").over(order).alias("next_line"))
    head = wrong.where(_wrong_part(F.col("first"), F.col("word"), F.col("second"))).select(*key, F.lit("misread").alias("kind"))
    second = F.lower(F.regexp_replace("second", r"""[.,;:?!"'”’)\]]+$""", ""))
    tail = wrong.where(~F.endswith("word", second)).join(following, key).where("next_line is not null").select("file_hash", F.col("next_page").alias("page_no"), F.col("next_line").alias("line_no"), F.lit("misread").alias("kind"))
    return r.furniture.select(*key, F.lit("furniture").alias("kind")).unionByName(hyphen).unionByName(misread).unionByName(head).unionByName(tail).distinct()


def _picked(units: DataFrame, r: Repairs, key: list[str]) -> DataFrame:
    """Of every token with candidates, in every line: the word that its neighbours' bigrams, its frequency and its cost pick; null for what was read.

    Each token is decided once with each pair of neighbours. What was read is a
    candidate too where the lexicon has it. It then bears the dearest cost that
    a repair of it may have, so that only bigrams speak for it, and those count
    without the occurrences between the same two neighbours: copies of one
    sentence don't bear each other out.
    """
    asked = units.where("what = 'word'").select(*key, "token", "left", "right")
    contexts = asked.groupBy("token", "left", "right").agg(F.count("*").alias("same"))
    own = r.words.where("own_often is not null").select("token", F.col("own").alias("word"), F.col("own_often").alias("often"), F.lit(DEAREST_OF_A_WORD).alias("cost"), F.lit(True).alias("as_read")).distinct()
    each = contexts.join(r.words.select("token", "word", "often", "cost", F.lit(False).alias("as_read")).unionByName(own), "token")
    left = r.bigrams.select(F.col("first").alias("left"), F.col("second").alias("word"), F.col("times").alias("left_times"))
    right = r.bigrams.select(F.col("first").alias("word"), F.col("second").alias("right"), F.col("times").alias("right_times"))
    mine = F.when(F.col("as_read"), F.col("same")).otherwise(0)
    support = lambda times: F.log1p(F.greatest(F.coalesce(times, F.lit(0)) - mine, F.lit(0)))
    scored = each.join(left, ["left", "word"], "left").join(right, ["word", "right"], "left").withColumn("score", support("left_times") + support("right_times") + 0.3 * F.log("often") - 8 * F.col("cost"))
    picks = scored.groupBy("token", "left", "right").agg(F.max_by(F.when(~F.col("as_read"), F.col("word")), F.struct("score", ~F.col("as_read"), "word")).alias("word"))
    return asked.join(picks, ["token", "left", "right"]).select(*key, "token", "word").distinct()


def _case(read: str, word: str) -> str:
    core = "".join(c for c in read if c.isalpha())
    return word.upper() if len(core) > 1 and core.isupper() else word[:1].upper() + word[1:] if core[:1].isupper() and read[:1].isalpha() else word


def _mend(token: str, word: str) -> str:
    """The token with the word in place of what was read; quotes, brackets and stops around it stay."""
    readings = ((k, m) for k in range(min(3, len(token))) for m in range(len(token), max(k, len(token) - 4), -1))
    fits = [(cost(token[k:m].lower(), word), k, m) for k, m in readings if all(c in _LEFT for c in token[:k]) and all(c in _RIGHT for c in token[m:])]
    _, k, m = min(fits, default=(0, 0, len(token)))
    return token[:k] + _case(token[k:m], word) + token[m:]


def _paragraphs(group: pa.Table) -> pa.Table:
    """The paragraphs of one stretch of a file's pages; the first may go on with the last of the stretch before."""
    rows = sorted(zip(*(group.column(c).to_pylist() for c in ("page_no", "line_no", "line", "words", "own", "joined", "prev_page", "prev_no", "before", "prev_own"))), key=lambda r: r[:2])
    paragraphs: list[list[str]] = []
    starts: list[int] = []
    held: str | None = None  # the first part of a word cut at the end of the line before
    widest = max((len(r[2].rstrip()) for r in rows), default=0)
    stands_apart = lambda line: bool(_LISTED.match(line.strip()) or _CAPTION.match(line.strip()) and len(line) < 0.6 * widest or not any(c.isalpha() for c in line))
    last, goes_on, glue = None, False, ""
    if rows and rows[0][6] is not None:
        _, _, _, _, _, _, prev_page, prev_no, before, prev_own = rows[0]
        last = (prev_page, prev_no, before.rstrip(), stands_apart(before), None)
        held = "" if prev_own is not None and before.split() and _cut(before.split()[-1]) else None
        glue = " " if held is None else ""
    for page, no, line, words, own, joined, *_ in rows:
        tokens = line.split()
        mends = {t: w for t, w in (words or [])}
        apart = stands_apart(line)
        fresh = last is None or line[:2].isspace() or apart or last[3]
        if last is not None and not fresh:
            fresh = no > last[1] + 1 if page == last[0] else last[2].endswith((".", "?", "!")) and len(last[2]) < 0.8 * widest
        if held is not None and not apart:
            fresh = False
        goes_on = goes_on or not paragraphs and not fresh
        if fresh or not paragraphs:
            if held and paragraphs:
                paragraphs[-1].append(held)
            if fresh:
                held = None
            paragraphs.append([])
            starts.append(page)
        out = [_mend(t, mends[t]) if t in mends else t for t in tokens]
        if held is not None and tokens:
            out[0] = held + tokens[0] if not isinstance(last[4], str) else _mend(held + tokens[0], last[4])
            held = None
        if tokens and own is not None and _cut(tokens[-1]):
            held = out.pop()[:-1] + ("-" if own else "")
        paragraphs[-1].extend(out)
        last = (page, no, line.rstrip(), apart, joined if held is not None and not own else None)
    if held and paragraphs:
        paragraphs[-1].append(held)
    keep = [(p, " ".join(t), k == 0 and goes_on) for k, (p, t) in enumerate(zip(starts, paragraphs)) if t]
    n, first = len(keep), group.slice(0, 1)
    return pa.table(
        {
            "file_hash": pa.array([first.column("file_hash")[0].as_py()] * n, pa.string()),
            "stretch": pa.array([first.column("stretch")[0].as_py()] * n, pa.int64()),
            "place": pa.array(range(n), pa.int32()),
            "page_no": pa.array([p for p, *_ in keep], pa.int32()),
            "text": pa.array([glue + t if g else t for _, t, g in keep], pa.string()),
            "goes_on": pa.array([g for *_, g in keep], pa.bool_()),
        }
    )


def paragraphs(pages: DataFrame, params: ScanParams = ScanParams()) -> DataFrame:
    """(file_hash, page_no, paragraph_no, text): the repaired text of every file in page order.

    ``page_no`` is where a paragraph begins; ``paragraph_no`` counts from 1 in
    each file. A blank line, an indent, a list item or a caption begins a
    paragraph, a page's end alone doesn't. Stretches of ``params.pages`` pages
    are read each for itself; a paragraph, or a cut word, that goes on in the
    next one is put together again.
    """
    r = analyse(pages, params)
    key = ["file_hash", "page_no", "line_no"]
    units = materialise(r.lines.mapInArrow(_occurrences(token_filter(r.words)), _UNIT), f"{scratch_dir(pages.sparkSession)}/units")
    picks = _picked(units, r, key).where("word is not null").groupBy(*key).agg(F.collect_list(F.array("token", "word")).alias("words"))
    cuts = units.where("what = 'cut'").select(*key, F.col("token").alias("first"), "second").join(r.cuts, ["first", "second"]).select(*key, "own", F.col("word").alias("joined"))
    order = Window.partitionBy("file_hash").orderBy("page_no", "line_no")
    lines = r.lines.select(*key, "line", "before").join(picks, key, "left").join(cuts, key, "left").withColumn("stretch", F.floor(F.col("page_no") / params.pages))
    lines = lines.select("*", F.lag("page_no").over(order).alias("prev_page"), F.lag("line_no").over(order).alias("prev_no"), F.lag("own").over(order).alias("prev_own"))
    parts = lines.groupBy("file_hash", "stretch").applyInArrow(_paragraphs, "file_hash string, stretch bigint, place int, page_no int, text string, goes_on boolean")
    number = F.sum((~F.col("goes_on")).cast("int")).over(Window.partitionBy("file_hash").orderBy("stretch", "place"))
    numbered = parts.withColumn("paragraph_no", number.cast("int")).groupBy("file_hash", "paragraph_no").agg(F.min("page_no").alias("page_no"), F.sort_array(F.collect_list(F.struct("stretch", "place", "text"))).alias("parts"))
    return numbered.select("file_hash", "page_no", "paragraph_no", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
