"""Per-document statistics of text, set against the distribution of each statistic in the document's language."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.util import cut

#: Statistics of a document, in the order in which they are given.
STATS = ("words", "word_length", "symbol_ratio", "digit_ratio", "punctuated_lines", "common_share", "item_share", "row_share", "lone_share", "repeat_share", "residue_share")
#: Ranks at which the sketches are read; a percentile is found among these.
RANKS = tuple(k / 100 for k in range(101))
#: A language that no common word tells; its documents are held against those of all languages together.
UNKNOWN = "und"
#: Documents of a language from which on its own distribution is one.
FEW = 30
#: Statistics of which the lower tail is far from prose; of the others it is the upper one.
LOW = ("common_share", "punctuated_lines")
#: The least spread of each statistic that counts, where a language's documents are more alike than that: texts of a few lines
#: differ by so much through chance.
SPREAD = {
    "words": 50.0, "word_length": 2.5, "symbol_ratio": 0.04, "digit_ratio": 0.1, "punctuated_lines": 0.285, "common_share": 0.02, "item_share": 0.085, "row_share": 0.085, "lone_share": 0.1, "repeat_share": 0.2,
    "residue_share": 0.036,
}

#: Rows of columns: tabs, bars, semicolons, wide gaps, commas without blanks, or nothing but numbers.
ROW = (
    r"[^\t]*+\t[^\t]*+\t|\s*+\|.*\||[^;]{1,30};[^;]{0,30};[^;]{0,30}|\s*+\S++(?: \S++){0,3}+(?:\s{2,}+\S++(?: \S++){0,3}+){2,}+\s*\Z"
    r"|[^, ][^,]{0,39},(?! )[^,]{0,40}(?:,(?! )[^,]{0,40})+\Z|\s*+(?:[<>~]?[-+]?\d[\d.,]*+\s++){2,}+[<>~]?[-+]?\d[\d.,]*+\s*\Z"
)
#: Items: bullets, numbers or letters before a short text, leaders to a page, a label with a value, an entry with its pages.
ITEM = (
    r"\s*[-•*·–—▪◦o]\s+\S.{0,90}\Z|\s*[(\[]?(?:\d{1,3}|[A-Za-z]|[ivxIVX]{1,5})[.)\]]\s+\S.{0,80}\Z|[^.]{1,80}(?:\.\s?){4,}+\s*\d+\s*\Z"
    r"|[^\W\d_][\w .'/()-]{0,30}: \S.{0,60}\Z|.{1,60}(?:, \d{1,4})+\s*\Z"
)
#: What a reader can't read: code of page descriptions, markup, text decoded with the wrong code page.
RESIDUE = r"\b(?:Tf|Td|Tj|TJ|BT|ET)\b|Ã.|â€|Â[^\s\w]|\ufffd|[─-▟]+|</?\w+[^>]{0,40}>"
_boxes = re.compile(r"[─-▟]").search
#: Of these, or the boxes, one stands in every match of RESIDUE; a plain search is far cheaper than the pattern.
_HINTS = ("Tf", "Td", "Tj", "TJ", "BT", "ET", "Ã", "â€", "Â", "\ufffd", "<")
_row, _item, _residue, _odd_chars = re.compile(ROW).match, re.compile(ITEM).match, re.compile(RESIDUE).findall, re.compile(r"[^\x00-\x7f\w\s]").findall
_digits = b"0123456789"
_plain = bytes(c for c in range(256) if c > 127 or chr(c).isalnum() or chr(c).isspace() or chr(c) in ".,;:()'\"-")


def measure(t: str, lists: list[frozenset]) -> tuple:
    """The counts from which statistics() derives its shares, in one pass over the text with the interpreter's own loops."""
    raw, words = t.encode("utf-8", "replace"), t.split()
    low, lines = t.lower().split(), [x for x in t.split("\n") if x and not x.isspace()]
    symbols = len(raw.translate(None, _plain))
    if len(raw) != len(t):
        symbols += len(_odd_chars(t))
    ended = items = rows = held = 0
    for x in lines:
        n = len(x)
        held += n
        end = x.rstrip().rstrip("\"')]")[-1:]
        ended += end in ".!?;:" and end != ""
        head = x[0]
        if (not head.isalpha() or x[1:2] in ").] " or ": " in x[:34] or end.isdigit()) and _item(x):
            items += n
        if ("\t" in x or "|" in x or "  " in x or x.count(";") > 1 or x.count(",") > 1 or end.isdigit()) and _row(x):
            rows += n
    lone = sum([w != w.upper() for w in low if len(w) < 3])
    residue = len(_residue(t)) if any([h in t for h in _HINTS]) or len(raw) != len(t) and _boxes(t) else 0
    found = [sum(map(words_of.__contains__, low)) for words_of in lists]
    best = max(found, default=0)
    return (len(words), sum(map(len, words)), symbols, len(raw) - len(raw.translate(None, _digits)), ended, items, rows, held, len(lines), lone, len(lines) - len(set(lines)), residue, best, found.index(best) if best else -1)


#: What measure() returns.
_COUNTS = ("words", "seen", "symbols", "digits", "ended", "items", "rows", "held", "lines", "lone", "repeats", "residue", "best", "language")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def statistics(documents: DataFrame, common: DataFrame) -> DataFrame:
    """(doc_id, language, *STATS): one row for each document.

    words: runs of visible characters. word_length: mean characters of the words. symbol_ratio, digit_ratio: shares of the
    visible characters. punctuated_lines: share of lines that end a sentence or clause. common_share: common words of the
    language among the words. item_share, row_share: share of characters in lines that look like items or rows. lone_share:
    words of one or two characters with a letter among them. repeat_share: lines that repeat another. residue_share: marks of code or of
    wrong decoding among the words. language is that of whose common words the text has most (equal: the first by name),
    whatever `lang` says; und if it has none. A null or empty text has 0 everywhere. `common` holds a fixed number of words.
    """
    rows = common.where("lang IS NOT NULL AND word <> ''").groupBy("lang").agg(F.collect_list("word").alias("words")).orderBy("lang").limit(201).collect()
    if len(rows) > 200:
        raise ValueError("more than 200 languages")
    lists = {r["lang"]: sorted({w.lower() for w in r["words"]}) for r in rows}
    sets = [frozenset(words) for words in lists.values()]

    @F.pandas_udf(", ".join(f"{c} long" for c in _COUNTS))
    def counted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t or "", sets) for t in texts], columns=list(_COUNTS), dtype="int64")

    c = {name: F.col(f"c.{name}") for name in _COUNTS}
    name = F.get(F.array(*[F.lit(x) for x in lists] or [F.lit(UNKNOWN)]), c["language"].cast("int"))
    return documents.select("doc_id", counted("text").alias("c")).select(
        "doc_id", F.when(c["best"] > 0, name).otherwise(UNKNOWN).alias("language"), c["words"].cast("double").alias("words"), _share(c["seen"], c["words"]).alias("word_length"),
        _share(c["symbols"], c["seen"]).alias("symbol_ratio"), _share(c["digits"], c["seen"]).alias("digit_ratio"), _share(c["ended"], c["lines"]).alias("punctuated_lines"),
        _share(c["best"], c["words"]).alias("common_share"), _share(c["items"], c["held"]).alias("item_share"), _share(c["rows"], c["held"]).alias("row_share"),
        _share(c["lone"], c["words"]).alias("lone_share"), _share(c["repeats"], c["lines"]).alias("repeat_share"), _share(c["residue"], c["words"]).alias("residue_share"),
    )


def distributions(stats: DataFrame) -> DataFrame:
    """(language, n, q): q maps each statistic to its values at RANKS, read from one mergeable sketch a language and statistic.

    The sketches of und, and of a language with fewer than FEW documents, are those of all languages but und, merged; of its
    own documents if there are no others.
    """
    sketches = stats.groupBy("language").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(s).alias(s) for s in STATS])
    known = F.col("language") != UNKNOWN
    # A row for each language, joined with the one row that they make together.
    merged = sketches.where(known).agg(F.count("*").alias("__k"), *[F.kll_merge_agg_double(s).alias(f"__{s}") for s in STATS])
    few = ~known | (F.col("n") < FEW)
    sketches = sketches.join(F.broadcast(merged), few, "left")
    read = [F.struct(*[F.kll_sketch_get_quantile_double(F.when(F.col("__k") > 0, F.col(f"__{s}")).otherwise(F.col(s)), F.array(*[F.lit(r) for r in RANKS])).alias(s) for s in STATS]).alias("q")]
    return sketches.select("language", "n", *read)


def scores(stats: DataFrame) -> DataFrame:
    """stats with z_<stat>: the distance from the language's median in units of its spread, towards what isn't prose above 0.

    The spread is the way from the median to the quartile on the other side, that of prose, scaled to a normal deviation: more
    than a quarter of a language may be no prose. It is at least SPREAD. `stats` should be cut or cached, as it is read twice.
    """
    side = {s: 75 if s in LOW else 25 for s in STATS}
    dist = distributions(stats).select("language", *[F.struct(F.get(F.col(f"q.{s}"), F.lit(50)).alias("m"), F.get(F.col(f"q.{s}"), F.lit(side[s])).alias("u")).alias(f"__{s}") for s in STATS])
    out = stats.join(F.broadcast(dist), "language")  # a row for each language of the common words
    z = lambda s: (F.col(s) - F.col(f"__{s}.m")) * (-1 if s in LOW else 1) / F.greatest(F.abs(F.col(f"__{s}.u") - F.col(f"__{s}.m")) / 0.6745, F.lit(SPREAD[s]))
    return out.select("doc_id", "language", *STATS, *[z(s).alias(f"z_{s}") for s in STATS])


def percentiles(stats: DataFrame) -> DataFrame:
    """(doc_id, language, *STATS, p_<stat>): each statistic with its percentile in the language, 0 to 100."""
    dist = distributions(stats).select("language", F.col("q").alias("__q"))
    out = stats.join(F.broadcast(dist), "language")
    rank = lambda s: F.greatest(F.size(F.filter(F.col(f"__q.{s}"), lambda q: q <= F.col(s))) - 1, F.lit(0))
    return out.select("doc_id", "language", *STATS, *[rank(s).alias(f"p_{s}") for s in STATS])


def flag(documents: DataFrame, common: DataFrame, tail: float = 3.5) -> DataFrame:
    """(doc_id, kind) of the documents that mostly aren't natural prose; kind is list, table or junk.

    Every statistic is held against its distribution in the document's language (a text without any common word against that
    of all languages): it is in its tail if it lies `tail` spreads from the median, see scores(). A document is flagged whose
    common_share is in its tail and another statistic too, or common_share or residue_share twice as far out. The kind is
    junk if residue or lone letters are in their tails, or items and rows aren't; else table if rows are further out than
    items, else list. A text without words has no kind. Repeated rows yield one row each.
    """
    s = scores(cut(statistics(documents, common)))
    return s.where(_odd(tail)).select("doc_id", _kind(tail).alias("kind"))


def _laid(tail: float) -> Column:
    return F.col("z_item_share") + F.col("z_row_share") > tail


def _odd(tail: float) -> Column:
    others = [F.col(f"z_{s}") > tail for s in STATS if s not in ("words", "common_share", "item_share", "row_share")]
    borne = _laid(tail)
    for other in others:
        borne = borne | other
    z = F.col("z_common_share")
    return (F.col("words") > 0) & ((z > tail) & borne | (z > 2 * tail) | (F.col("z_residue_share") > 2 * tail))


def _kind(tail: float) -> Column:
    junk = (F.col("z_residue_share") > tail) | (F.col("z_lone_share") > tail) | ~_laid(tail)
    return F.when(junk, "junk").when(F.col("z_row_share") > F.col("z_item_share"), "table").otherwise("list")
