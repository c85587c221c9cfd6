"""Text expressions: white space, paragraphs, chunkers, quality. Columns only, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the 29 code points that count as white space, in a notation
#: that Java's and RE2's regular expressions share.
SPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
#: Ordered patterns of document types, and English function words.
DOCUMENT_TYPES = (
    (r"\b(lecture|notes?)\b", "lecture"),
    (r"\b(assignment|homework|hw)\b", "assignment"),
    (r"\b(exam|test|quiz|midterm|final)\b", "exam"),
    (r"\b(textbook|book|manual)\b", "textbook"),
    (r"\b(syllabus|outline)\b", "syllabus"),
    (r"\b(lab|laboratory|practical)\b", "lab"),
    (r"\b(project|report)\b", "project"),
    (r"\bpq\b", "exam"),
)
#: The same patterns with the word boundary spelt out (a word is of letters, digits and ``_`` of any script),
#: since ``\b`` beyond ASCII differs between regular-expression engines.
DOCUMENT_TYPES_ANY_SCRIPT = tuple((r"(^|[^\p{L}\p{N}_])" + pattern.removeprefix(r"\b").removesuffix(r"\b") + r"([^\p{L}\p{N}_]|$)", name) for pattern, name in DOCUMENT_TYPES)
ENGLISH = ("the", "and", "or", "but", "of", "with", "for", "to")
#: Fixed value: sentences with these phrases are dropped from generated text.
MUTTERING = r"(?i)\b(let\s+me|let's|assume|apologies|re-?calculate|recheck)\b"


def strip(text: Column) -> Column:
    """White space of all kinds off both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def effective_length(text: Column) -> Column:
    """Characters that aren't white space; 0 for null."""
    return F.coalesce(F.length(F.regexp_replace(text, f"{SPACE}+", "")), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{NOT_SPACE}+")), F.lit(0))


def words(text: Column) -> Column:
    """Words between white space; none for blank or null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def paragraphs(text: Column) -> Column:
    """Stripped parts between blank lines, without blank ones; empty for blank or null text."""
    unix = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    return F.filter(F.transform(F.split(unix, rf"\n{SPACE}*\n"), strip), lambda p: p != "")


def lines(text: Column) -> Column:
    """Stripped lines, without blank ones."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n?|\n"), strip), lambda p: p != "")


def _fold(parts: Column, joins, glue: str) -> Column:
    """Greedy merge of neighbours: (finished list, open buffer) over the parts; ``joins`` compares lengths, which are carried along."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("n"))

    def step(acc: Column, part: Column) -> Column:
        more = F.struct(acc["out"].alias("out"), F.concat(acc["open"], F.lit(glue), part).alias("open"), (acc["n"] + len(glue) + F.length(part)).alias("n"))
        fresh = F.struct(F.array_append(acc["out"], acc["open"]).alias("out"), part.alias("open"), F.length(part).alias("n"))
        first = F.struct(acc["out"].alias("out"), part.alias("open"), F.length(part).alias("n"))
        return F.when(acc["open"].isNull(), first).when(joins(acc["n"], F.length(part)), more).otherwise(fresh)

    return F.aggregate(parts, start, step, lambda a: F.when(a["open"].isNull(), a["out"]).otherwise(F.array_append(a["out"], a["open"])))


def merge_paragraphs(parts: Column, least: int = 200, most: int = 1600) -> Column:
    """Neighbours join while the buffer is short or the sum fits; one part alone may exceed ``most``."""
    return _fold(parts, lambda held, new: (held < least) | (held + 2 + new <= most), "\n\n")


def with_overlap(chunks: Column, overlap: int = 80) -> Column:
    """Each chunk but the first begins with the end of the one before, from its first space on."""
    if overlap <= 0:
        return chunks

    def add(every: Column, chunk: Column, at: Column) -> Column:
        before = F.get(every, at - 1)
        tail = F.right(before, F.lit(overlap))
        space = F.instr(tail, " ")
        return F.when(at == 0, chunk).otherwise(F.concat(F.when(space > 1, F.substring(tail, space + 1, F.lit(overlap))).otherwise(tail), F.lit(" "), chunk))

    # bound to a variable, the chunks are made once and not for each of them
    return F.get(F.transform(F.array(chunks), lambda every: F.transform(every, lambda chunk, at: add(every, chunk, at))), F.lit(0))


def chunk(parts: Column, least: int = 200, most: int = 1600, overlap: int = 80) -> Column:
    """Paragraph chunks with overlap."""
    return with_overlap(merge_paragraphs(parts, least, most), overlap)


def drop_page_breaks(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\n?-+ PAGE BREAK -+\n?", "\n\n")


def chunk_by_characters(text: Column, most: int = 1000) -> Column:
    """Paragraphs joined while the buffer, with a blank line after each, and the next stay below ``most``."""
    return _fold(paragraphs(drop_page_breaks(text)), lambda held, new: held + 2 + new < most, "\n\n")


def chunk_by_words(parts: Column, most: int = 300, overlap: int = 50, least: int = 20, full_overlap_only: bool = False) -> Column:
    """Parts joined up to ``most`` words; each new chunk repeats the last words of the one before; short chunks go.

    Every part is divided into words once. The open chunk carries their number
    and its last words, so that nothing is divided again.
    """
    start = F.struct(
        F.array().cast("array<struct<text:string,n:int>>").alias("out"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("tail")
    )
    last = lambda ws: F.slice(ws, F.greatest(F.size(ws) - overlap + 1, F.lit(1)), F.lit(overlap))
    state = lambda out, text, n, tail: F.struct(out.alias("out"), text.alias("open"), n.cast("int").alias("n"), tail.alias("tail"))
    done = lambda acc: F.array_append(acc["out"], F.struct(acc["open"].alias("text"), acc["n"].alias("n")))

    def step(acc: Column, part: Column) -> Column:
        text, ws = part["text"], part["words"]
        more = state(acc["out"], F.concat(acc["open"], F.lit("\n\n"), text), acc["n"] + F.size(ws), last(F.concat(acc["tail"], ws)))
        again = state(done(acc), F.concat(F.array_join(acc["tail"], " "), F.lit("\n\n"), text), F.size(acc["tail"]) + F.size(ws), last(F.concat(acc["tail"], ws)))
        alone = state(done(acc), text, F.size(ws), last(ws))
        fresh = F.when(acc["n"] >= overlap, again).otherwise(alone) if full_overlap_only else again
        return F.when(acc["open"].isNull(), state(acc["out"], text, F.size(ws), last(ws))).when(acc["n"] + F.size(ws) <= most, more).otherwise(fresh)

    divided = F.transform(parts, lambda p: F.struct(p.alias("text"), words(p).alias("words")))
    merged = F.aggregate(divided, start, step, lambda a: F.when(a["open"].isNull(), a["out"]).otherwise(done(a)))
    return F.transform(F.filter(merged, lambda c: c["n"] >= least), lambda c: c["text"])


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.coalesce(F.length(text), F.lit(0)) / 4)).cast("bigint")


def document_type(text: Column) -> Column:
    """The first type whose pattern occurs, in a text of any script; null if none does."""
    low = F.lower(text)
    out = F.when(low.rlike(DOCUMENT_TYPES_ANY_SCRIPT[0][0]), DOCUMENT_TYPES_ANY_SCRIPT[0][1])
    for pattern, name in DOCUMENT_TYPES_ANY_SCRIPT[1:]:
        out = out.when(low.rlike(pattern), name)
    return out


def language_flag(text: Column) -> Column:
    """'english' where three of eight function words stand between spaces, else 'unknown'."""
    low = F.lower(text)
    found = sum((F.when(F.contains(low, F.lit(f" {w} ")), 1).otherwise(0) for w in ENGLISH), F.lit(0))
    return F.when(found >= 3, "english").otherwise("unknown")


def sentence_count(text: Column) -> Column:
    """Parts between stops with anything but white space in them."""
    inside = NOT_SPACE.replace("[^", "[^.!?", 1)
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^.!?]*?{inside}[^.!?]*")), F.lit(0))


def readability_of(n_words: Column, n_letters: Column, n_sentences: Column) -> Column:
    """100 less half the words a sentence and twice the letters a word, within 0 and 100; null without words."""
    score = F.lit(100.0) - (n_words / n_sentences * 0.5 + n_letters / n_words * 2.0)
    return F.when((n_words > 0) & (n_sentences > 0), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))


def readability(text: Column) -> Column:
    """``readability_of`` a text; where the counts are columns of their own anyway, they serve better."""
    return readability_of(word_count(text), effective_length(text), sentence_count(text))


def drop_muttering(text: Column) -> Column:
    """Sentences without the phrases of ``MUTTERING``, white space single."""
    parts = F.split(strip(text), r"(?<=[.!?])" + SPACE + "+")
    kept = F.filter(parts, lambda s: ~s.rlike(MUTTERING))
    return F.regexp_replace(strip(F.array_join(kept, " ")), f"{SPACE}+", " ")


def snapshot(text: Column, most: int = 240) -> Column:
    """One line of at most ``most`` characters, with an ellipsis where more follows."""
    flat = strip(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "))
    return F.when(F.length(flat) > most, F.concat(F.left(flat, F.lit(most)), F.lit("…"))).otherwise(flat)
