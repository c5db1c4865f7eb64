"""Noise in text from scanned pages: finding it line by line, and putting the text back into paragraphs."""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.util import cut

#: A word belongs to the lexicon if it makes up this share of all words; so it has at most 1 / RATE words, at any size.
RATE, LEAST = 4e-6, 4
#: A line is a heading, not a running header, if it stands in this share of all reports; at most 1 / REPORTS a line of each.
REPORTS, LEAST_REPORTS = 0.002, 3
#: A word that is this many times rarer than one it may be a misreading of, is one.
RARER = 100
#: A name is taken for a misread word only if that word makes up this share of all words: names look like each other.
COMMON = 5e-5
#: Places of one report in which a line must stand to be its running header, where nothing else tells.
RUNNING = 2
#: Characters by which the width of a paragraph is told in its state, while paragraphs are chosen.
STEP = 8
#: Costs of the decoder, in units of -log probability: reading a letter as another, a word of no lexicon and each letter of
#: it, a blank or line end inside a word, a hyphen at a line end inside a word, and two words without a blank.
CONFUSED, UNKNOWN, LETTER, BLANK, HYPHEN, JOINED = 6.0, 9.0, 1.1, 4.0, 0.3, 5.0

#: Shapes that scanners take for each other, written as the strokes they have in common: rn, in and m are three
#: upright strokes, ri, ii, li, n, u, h and b two, vv is w and cl is d.
SHAPES = str.maketrans(
    {"m": "lll", "n": "ll", "u": "ll", "h": "ll", "b": "ll", "8": "ll", "i": "l", "1": "l", "!": "l", "|": "l", "r": "l", "ï": "l", "î": "l", "w": "vv", "y": "v", "d": "el", "c": "e", "(": "e", "ç": "e", "3": "e", "é": "e", "è": "e", "ê": "e", "ë": "e", "0": "o", "ô": "o", "5": "s", "$": "s", "9": "g", "6": "g", "q": "g", "4": "a", "@": "a", "à": "a", "â": "a", "f": "t", "7": "t", "þ": "p", "û": "ll", "ù": "ll", "2": "z"}
)
#: Letters and signs that a digit may be read as.
DIGITS = str.maketrans({"O": "0", "o": "0", "D": "0", "Q": "0", "l": "1", "I": "1", "i": "1", "|": "1", "!": "1", "Z": "2", "z": "2", "E": "3", "A": "4", "S": "5", "s": "5", "b": "6", "G": "6", "T": "7", "B": "8", "g": "9", "q": "9"})
#: Characters of the longest run that may be a word of the lexicon, and of the longest code that is looked for with misread signs.
LONGEST, CODE = 40, 16
HYPHENS = "-‐­¬=‑"
EDGE = ".,;:()?\"'[]«»“”"
#: What may follow a word; an opening bracket at its end is a misread c.
CLOSE = ".,;:)?\"']»”"
_number = re.compile(r"[+-]?\d[\d.,/:%-]*").fullmatch
_code = re.compile(r"L\d+\+\d\d[NSEW]?|\d{1,3}[NSEW]|\d{2,3}[A-P](?:/\d{1,2})?(?:-\d+)?|[A-Z]{1,3}\d{4,}|[A-Z]{2}-\d{1,3}-\d{1,3}|\d+(?:st|nd|rd|th|e|er|m|km|ppm|ppb|g|cm)|[A-Z][a-z]?\d?[A-Z][a-z]?\d?|\d{1,2}-\d{1,3}|(?:19|20)\d\d[a-z]?").fullmatch
_page = re.compile(
    r"[\W_]*(?:(?:page|pg|p|folio)\b\.?[\s:]*)?(?:[\dIlOoSZBzgsb|!]{1,4}|[ivxlcIVXLC]{1,7}|[\dlOSZ]{1,2}\s?[-–]\s?[\dlOSZ]{1,3})(?:\s*(?:of|de|sur|/)\s*[\dIlOoSZBzgs|!]{1,4})?[\]\)\s–—_-]*",
    re.IGNORECASE,
).fullmatch
_figure = re.compile(r"[<>~]?[\dlOISZBgzo|!]*\d[\dlOISZBgzo|!]*(?:[.,][\dlOISZBgzo|!]+)?%?|tr|nil|n/?[ad]|[<>]\d+").fullmatch
_page_word = re.compile(r"\W*(?:page|pg|p|folio)\b", re.IGNORECASE).match
_PAGE_NO = r"[-–\[(]?\s*(?:(?:page|pg|p)\b\.?\s*)?(?:[\dIlOSZ|]{1,4}(?:\s?[-–]\s?[\dIlOSZ|]{1,3}|\s(?:of|de|sur)\s[\dIlOSZ|]{1,4})?|[ivxl]{1,7})\s*[-–\])]?"
_page_edge = re.compile(rf"\s{{2,}}{_PAGE_NO}$|^{_PAGE_NO}\s{{2,}}", re.IGNORECASE).sub
_numbered = re.compile(r"[\dlOISbBgZz!|o]{1,2}(?:[.,][\dlOISbBgZz!|o]{1,2})*\.?\s+(?=[^\W\d])").match
_numbered_sub = re.compile(r"^[\dlOISbBgZz!|o]{1,2}(?:[.,][\dlOISbBgZz!|o]{1,2})*\.?\s+(?=[^\W\d])").sub
#: Letters with a sign, a digit or a capital among them, as no word has.
_mixed = re.compile(r"[a-z][A-Z][a-z]|[a-zé][0-9@$!|þ][a-zé]|[a-zé]{2}[0-9@$!|þ]$").search
#: Words that stay small in titles and running headers.
SMALL = frozenset("of on the by for and no no. to in a an at from de du des la le les sur et par pour report rapport file dossier project projet prepared work page p p.".split())


_shape = {chr(c): v for c, v in SHAPES.items()}.get


def skeleton(word: str) -> str:
    """A word as the strokes by which scanners tell letters."""
    return word.translate(SHAPES)


def loose_title(line: str) -> bool:
    """Whether a line might be a title with small words in it, as French ones have."""
    return len(line) <= 45 and line[0].isupper() and line[-1] not in ".,;:!?" and line[-1] not in HYPHENS and "\t" not in line and len(line.split()) <= 5


def titled(line: str) -> bool:
    """Whether a line might be a title or a running header: short, without a sentence's end, no small words but SMALL."""
    if len(line) > 80 or line[-1] in ".,;:!?" and not line.endswith("no.") or line[-1] in HYPHENS or "\t" in line:
        return False
    words = line.split()
    return len(words) <= 10 and not any(w[0].islower() and w.strip(EDGE).lower() not in SMALL for w in words)


def heading_key(line: str) -> str:
    """What the copies of a heading have in common; '' for a line with a number in it, beside the number of a section."""
    plain = re.sub(r"\s+", " ", _numbered_sub("", line).lower()).strip()
    return "" if any(c.isdigit() for c in plain) else skeleton(plain)


def running_keys(line: str) -> list[str]:
    """What the copies of a running header have in common: the strokes of its words without page numbers, whole and less each word.

    Two copies that differ in one word, as misread ones do, have one of the keys in common.
    """
    words = [skeleton(w) for w in (_page_edge("", line).strip() or line).lower().split()]
    if len(words) < 3:
        return ["".join(words)]
    return sorted({" ".join(words), *(" ".join(words[:k] + ["*"] + words[k + 1 :]) for k in range(len(words)))})


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words and title-like lines of a partition, counted before the shuffle."""
    words: Counter = Counter()
    lines: set = set()

    def out() -> pd.DataFrame:
        merged: Counter = Counter()
        for w, n in words.items():
            x = w.strip(EDGE).lower()
            if x and len(x) <= 40 and not _number(x):
                merged[x] += n
        rows = [("w", w, "", n) for w, n in merged.items()] + [("h", k, r, 1) for k, r in lines] + [("t", "", "", sum(words.values()))]
        return pd.DataFrame(rows, columns=["kind", "key", "report", "n"])

    for batch in batches:
        for text, report in zip(batch.chunk_text, batch.report_id):
            if not text:
                continue
            words.update(text.split())
            if "\n" in text:
                for line in text.split("\n"):
                    s = line.strip()
                    if s and len(s) <= 80 and (titled(s) or loose_title(_numbered_sub("", s) or s)) and (key := heading_key(s)):
                        lines.add((key, report or ""))
        if len(words) > 400_000 or len(lines) > 400_000:
            yield out()
            words.clear()
            lines.clear()
    yield out()


class _Plain(dict):
    """token -> whether it is a word of the lexicon, a number or a code as it stands, or has no letters: nothing to decode.

    Filled as it is asked; a full table is emptied, which costs time and changes nothing else.
    """

    def __init__(self, words: dict[str, int]) -> None:
        self.words = words

    def __missing__(self, token: str) -> bool:
        x = token.lstrip(EDGE).rstrip(CLOSE)
        v = "\x1f" not in token and (not x or x.lower() in self.words or bool(_number(x)) or bool(_code(x)) or not any(c.isalpha() or c in "!|$@" for c in x))
        if len(self) > 600_000:
            self.clear()
        self[token] = v
        return v


class Reader:
    """The lexicon of a corpus and the decoder over it."""

    def __init__(self, words: dict[str, int], headings: frozenset[str], total: int) -> None:
        top: dict[str, tuple[int, str]] = {}
        for w, n in words.items():
            if len(w) > 1 and any(c.isalpha() for c in w):
                k = skeleton(w)
                top[k] = max(top.get(k, (0, "")), (n, w))
        misread = {w for w, n in words.items() if n * RARER < top.get(skeleton(w), (0, ""))[0] and not _code(w.upper()) and not w.isdigit()}
        self.words = {w: n for w, n in words.items() if w not in misread}
        self.top = {k: nw for k, nw in top.items() if nw[1] not in misread}
        self.headings, self.total = headings, max(total, 1)
        self.plain = _Plain(self.words).__getitem__
        self.decoded: dict[str, tuple] = {}

    def word_cost(self, u: str) -> tuple[float, str, bool]:
        """(cost, word, misread) of the cheapest reading of a run of characters as one word."""
        x = u.lstrip(EDGE).rstrip(CLOSE)
        low = x.lower()
        if low in self.words:
            return math.log(self.total / self.words[low]), u, False
        if not x or _number(x) or _code(x):
            return 8.0, u, False
        fixed = x.translate(DIGITS)
        if fixed != x and _number(fixed) and sum(c.isdigit() or c in ".," for c in x) * 2 >= len(x):
            return 8.0 + CONFUSED, u.replace(x, fixed), True
        for k in range(1, len(x)) if len(x) <= CODE and any(c.isdigit() for c in x) else ():
            for lead in (x[:k] + fixed[k:], fixed[:k] + x[k:]):
                if lead != x and _code(lead):
                    return 9.0 + CONFUSED, u.replace(x, lead), True
        n, w = self.top.get(skeleton(low), (0, ""))
        if n < self.total * COMMON and x[:1].isupper() and x.isalpha():
            n = 0
        if n and w != low and (len(low) > 2 or not low.isalpha()) and (x[:1].islower() or not x[:1].isalpha() or len(x) > 3):
            w = w.upper() if x.isupper() and len(x) > 1 else w.capitalize() if x[0].isupper() else w
            return math.log(self.total / n) + CONFUSED, u.replace(x, w), True
        cost = UNKNOWN + LETTER * len(x)
        if "-" in x.strip("-"):
            parts = [self.word_cost(p) for p in x.split("-") if p]
            if any(m for _, _, m in parts) and sum(c for c, _, _ in parts) < cost + CONFUSED * len(parts):
                return cost, u.replace(x, "-".join(w for _, w, _ in parts)), True
        return cost, u, len(x) > 3 and bool(_mixed(x)) and not x.startswith(("Mc", "Mac", "De", "La"))

    def decode(self, stream: str) -> list[tuple[int, int, str, bool]]:
        """(from, to, word, misread) of the words of a stream of characters, whose blanks and line ends are only hints.

        In the stream \x1f stands for a hyphen at a line end. A word may run over blanks and such hyphens (a merge), words of
        the lexicon may stand without a blank (a split), and letters may be misread; the reading with the least cost in all is
        taken. A word of no lexicon ends at the next blank.
        """
        if stream in self.decoded:
            return self.decoded[stream]
        n, gaps = len(stream), " \n\x1f"
        best: list[float] = [0.0] + [math.inf] * n
        back: list[tuple] = [(0, "", False)] * (n + 1)
        low = stream.lower()
        if len(low) != n:
            low = [c.lower() for c in stream]
        shapes = [_shape(c, c) for c in low]
        gap = [n] * n  # where the next blank is
        for k in range(n - 2, -1, -1) if n > LONGEST else ():
            gap[k] = k + 1 if stream[k + 1] in gaps else gap[k + 1]
        for i in range(n):
            if best[i] == math.inf:
                continue
            if stream[i] in gaps:
                cost = best[i] + (1.5 if stream[i] == "\x1f" else 0.0)
                if cost < best[i + 1]:
                    best[i + 1], back[i + 1] = cost, (i, "", False)
                continue
            plain, kept, small, strokes, extra, j = "", "", "", "", 0.0, i
            while j < n and (extra == 0.0 or j - i < LONGEST):
                if j - i >= LONGEST:  # nothing but a word of no lexicon, up to the next blank
                    j = gap[i]
                    cost = best[i] + UNKNOWN + LETTER * (j - i)
                    if cost < best[j]:
                        best[j], back[j] = cost, (i, stream[i:j], False)
                    break
                elif stream[j] in gaps:
                    extra += HYPHEN if stream[j] == "\x1f" else BLANK
                    kept += "-" if stream[j] == "\x1f" else ""
                    if extra > 2 * BLANK or stream[j] != "\x1f" and stream[j + 1 : j + 2].isupper() and not plain[-1].isupper():
                        break
                    j += 1
                    continue
                else:
                    plain, kept, small, strokes = plain + stream[j], kept + stream[j], small + low[j], strokes + shapes[j]
                j += 1
                ends = j == n or stream[j] in gaps
                if not ends and (j - i < 3 or n - j < 3 or small not in self.words and strokes not in self.top):
                    continue
                if extra >= BLANK and (bare := small.strip(EDGE)) not in self.words and skeleton(bare) not in self.top:
                    continue
                cost, word, misread = min(self.word_cost(plain), self.word_cost(kept)) if kept != plain else self.word_cost(plain)
                cost += best[i] + extra + (0.0 if ends else JOINED)
                if cost < best[j]:
                    best[j], back[j] = cost, (i, word, misread)
        out, at = [], n
        while at > 0:
            i, word, misread = back[at]
            if word:
                out.append((i, at, word, misread))
            at = i
        out.reverse()
        if len(self.decoded) > 300_000:
            self.decoded.clear()
        if n < 100:
            self.decoded[stream] = out
        return out

    def meet(self, a: str, b: str) -> bool:
        """Whether a word of the lexicon may run over the blank between two tokens, one of which at least isn't plain."""
        x, y = a.lower(), b.lower()
        if not x[-1].isalpha() or not y[0].isalpha() or b[0].isupper() and not a[-1].isupper():
            return False
        whole = (x + y).strip(EDGE)
        if whole in self.words or skeleton(whole) in self.top:
            return True
        y, x = y.rstrip(EDGE), x.lstrip(EDGE)
        return any(x[i:] + y in self.words for i in range(3, len(x))) or any(x + y[:j] in self.words for j in range(1, len(y) - 3))

    def windows(self, tokens: Sequence[str]) -> list[tuple[int, int]]:
        """(from, to) of the runs of a stream's tokens that must be decoded.

        Where no word can run over the blank between two tokens, the best reading of the stream has an end of a word, so it is
        that of the parts on both sides, and a plain token between two such blanks is its own reading. What is left are the
        tokens that aren't plain, with those neighbours that a word might run into; two tokens that aren't plain always belong
        together, as do the three parts of a word. The readings of these windows make up that of the whole stream.
        """
        last = len(tokens) - 1
        odd = [k for k, v in enumerate(map(self.plain, tokens)) if not v]
        joined: set[int] = set()  # tokens from which a word may run into the next
        if not self.words.keys().isdisjoint(map(str.lower, map(add, tokens, tokens[1:]))):
            joined = {k for k in range(last) if (tokens[k] + tokens[k + 1]).lower() in self.words}
        others = set(odd)
        for k in odd:
            if k < last and (k + 1 in others or self.meet(tokens[k], tokens[k + 1])):
                joined.add(k)
            if k and k - 1 not in others and self.meet(tokens[k - 1], tokens[k]):
                joined.add(k - 1)
            if k + 2 in others and k + 1 not in others:
                whole = "".join(tokens[k : k + 3]).strip(EDGE).lower()
                if whole in self.words or skeleton(whole) in self.top:
                    joined |= {k, k + 1}
        out: list[tuple[int, int]] = []
        for k in sorted(others | joined):
            if out and k < out[-1][1]:
                continue
            end = k + 1
            while end - 1 in joined:
                end += 1
            out.append((k, end))
        return out

    def read(self, tokens: Sequence[str], windows: list[tuple[int, int]] | None = None) -> Iterator[tuple[int, int, str, bool]]:
        """(from, to, word, misread) for each word that the decoder reads in the windows of a stream: the tokens it has a part of."""
        for a, b in self.windows(tokens) if windows is None else windows:
            if b == a + 1:
                for _, _, word, misread in self.decode(tokens[a]):
                    yield a, b, word, misread
                continue
            part = tokens[a:b]
            starts = [0]
            for t in part[:-1]:
                starts.append(starts[-1] + len(t) + 1)
            for i, j, word, misread in self.decode(" ".join(part)):
                yield a + bisect_right(starts, i) - 1, a + bisect_right(starts, j - 1), word, misread

    def kinds(self, lines: list[str]) -> list[str]:
        """What each line is: blank, page_no, header, header?, title (a heading or a table's line), or text.

        A line with the look of a header is one if it has a page number on it or near it, or interrupts a sentence. If nothing
        tells it is `header?`: a header if it runs through its report, else a title.
        """
        out = []
        for line in lines:
            s = line.strip()
            if not s:
                out.append("blank")
            elif len(s) <= 30 and _page(s) and (not s.endswith(".") or _page_word(s)) and not (len(s) == 1 and s.isalpha() and s not in "ivxIVX"):
                out.append("page_no")
            elif "\t" in s or s.endswith(":") and len(s) < 60:
                out.append("title")
            elif len(s) > 110:
                out.append("text")
            else:
                core = _page_edge("", s).strip() or s
                if not titled(core):
                    known = loose_title(_numbered_sub("", core) or core) and (_numbered(core) or heading_key(core) in self.headings)
                    out.append("title" if known else "text")
                elif core == s and heading_key(core) in self.headings or _numbered(core) and not re.search(r"\d{4}|[-–/|,]", core[4:]):
                    out.append("title")
                else:
                    out.append("header")
        filled = [k for k, kind in enumerate(out) if kind != "blank"]
        figures = {k for k in filled if _figure(lines[k].strip())}
        for at, k in enumerate(filled):
            # Figures one below the other are a column of a table, not page numbers.
            near = {filled[j] for j in (at - 1, at + 1) if 0 <= j < len(filled)}
            if k in figures and (near & figures or at and lines[filled[at - 1]].rstrip().endswith(":") or not lines[k].strip().isdigit()):
                out[k] = "title"
        for k, kind in enumerate(out):
            if kind not in ("header", "title") or "\t" in lines[k] or k in figures:
                continue
            s = lines[k].strip()
            before = next((lines[j].strip() for j in range(k - 1, -1, -1) if out[j] == "text"), "")
            after = next((lines[j].strip() for j in range(k + 1, len(lines)) if out[j] == "text"), "")
            broken = bool(before) and before[-1] not in ".:;!?)\"" and bool(after) and (after[0].islower() or after[0].isdigit())
            if kind == "title":
                if broken and titled(s) and not _numbered(s):
                    out[k] = "header"
            elif len(lines) == 1:
                out[k] = "text"
            elif not broken and _page_edge("", s).strip() in ("", s) and not any(out[j] == "page_no" for j in range(max(k - 2, 0), min(k + 3, len(lines)))):
                out[k] = "header?"
        return out

    def paragraphs(self, lines: list[str], kinds: list[str], keep: list[int]) -> list[list[int]]:
        """The lines of `keep` in paragraphs, by dynamic programming: the ends with the least sum of costs in all.

        The state at a line is how wide the lines of its paragraph are so far, in steps of STEP characters, and whether it is
        its first. To go on costs more where the next line's first word would have had room on this one, measured by the
        paragraph's own width, at a sentence's end, a blank line or a title; to end costs more within a sentence, after a full
        line, and for a paragraph of one line. So whether a line is short depends on the lines it is put together with.
        """
        if not keep:
            return []
        texts = [lines[k].strip() for k in keep]
        size = [len(t) for t in texts]
        states: dict[tuple[int, bool], float] = {(size[0] // STEP, True): 0.0}
        trace: list[dict[tuple[int, bool], tuple[tuple[int, bool], bool]]] = []
        for at in range(len(keep) - 1):
            here, after, s, t = keep[at], keep[at + 1], texts[at], texts[at + 1]
            gap, title = False, kinds[here] == "title" or kinds[after] == "title"
            if after > here + 1:
                between = kinds[here + 1 : after]
                gap = "blank" in between and "page_no" not in between and "header" not in between and "header?" not in between
            stop, capital, wide_here, wide_next = s[-1] in ".:!?)", not t[0].islower(), size[at], size[at + 1]
            first = t.find(" ")
            need, level = wide_here + 1 + (first if first > 0 else wide_next), wide_next // STEP
            deeper = len(lines[after]) - len(lines[after].lstrip()) > len(lines[here]) - len(lines[here].lstrip()) + 1
            go_on = 1.0 + 5.0 * gap + 9.0 * title
            stay = 0.5 + 2.0 * (stop and capital)
            end_here = 2.0 + 4.0 * (not stop) + 4.0 * (not capital) - 6.0 * gap - 8.0 * title - 1.0 * deeper
            cut_word = 20.0 if s[-1] in HYPHENS and not capital and not title else 0.0
            new: dict[tuple[int, bool], float] = {}
            back: dict[tuple[int, bool], tuple[tuple[int, bool], bool]] = {}
            ended, ended_by = math.inf, None
            for state, cost in states.items():
                wide, alone = state
                room = need <= wide * STEP or need <= wide_next
                total = cost + go_on + (stay if room else 0.0)
                key = (wide if wide > level else level, False)
                if total < new.get(key, math.inf):
                    new[key], back[key] = total, (state, False)
                end = end_here + (0.0 if room else 1.0) + (0.5 if alone and not title else 0.0)
                total = cost + (end if end > 0.0 else 0.0) + cut_word
                if total < ended:
                    ended, ended_by = total, state
            new[(level, True)], back[(level, True)] = ended, (ended_by, True)
            states = new
            trace.append(back)
        state, out = min(states, key=lambda x: (states[x], x)), [[keep[-1]]]
        for at in range(len(trace) - 1, -1, -1):
            state, ended = trace[at][state]
            if ended:
                out.append([keep[at]])
            else:
                out[-1].append(keep[at])
        return [p[::-1] for p in reversed(out)]

    def stream(self, lines: list[str], numbers: Sequence[int]) -> tuple[list[str], list[int]]:
        """The tokens of de-lined lines, and the line of each; a word with a hyphen at a line's end is one token with the next."""
        tokens: list[str] = []
        of: list[int] = []
        for k in numbers:
            new = lines[k].split()
            if tokens and new and len(tokens[-1]) > 1 and tokens[-1][-1] in HYPHENS and tokens[-1][-2].isalpha():
                tokens[-1] = f"{tokens[-1][:-1]}\x1f{new.pop(0)}"
            tokens += new
            of += [k] * len(new)
        return tokens, of

    def find(self, text: str) -> list[tuple[int, str]]:
        """(line_no, kind) of each kind of noise in each line of a text; `header?` are lines that are headers if they run."""
        lines = text.split("\n")
        words = text.split()
        flat = all(map(self.plain, set(words))) and self.words.keys().isdisjoint(map(str.lower, map(add, words, words[1:])))
        if len(lines) == 1 and flat:
            return []
        kinds = self.kinds(lines)
        out = [(k, kind) for k, kind in enumerate(kinds) if kind in ("page_no", "header", "header?")]
        body = [k for k, kind in enumerate(kinds) if kind == "text"]
        ends = {}
        for here, after in zip(body, body[1:]):
            s, t = lines[here].rstrip(), lines[after].lstrip()
            if len(s) > 1 and s[-1] in HYPHENS and s[-2].isalpha() and t[0].isalnum():
                out.append((here, "hyphen"))
                ends[here] = after
        if flat and not ends:
            return out
        bad: set[int] = set()
        names: Counter = Counter()
        where: dict[str, set[int]] = {}
        last = len(lines) - 1 if text.rstrip()[-1:].isalnum() else -1
        tokens, of = self.stream(lines, body)
        windows = self.windows(tokens)
        streams = [(tokens, of, windows)]
        if any(of[a] != of[b - 1] for a, b in windows):  # words may run over the ends of lines: not over those of paragraphs
            streams = [(*self.stream(lines, numbers), None) for numbers in self.paragraphs(lines, kinds, body)]
        for tokens, of, windows in streams:
            for a, b, word, misread in self.read(tokens, windows):
                if of[b - 1] == last and b == len(tokens) and b == a + 1:
                    continue  # the chunk ends within a word, perhaps
                halves = tokens[a].split("\x1f")
                if misread:
                    got = word.replace("-", "").lower()
                    head = halves[0].lower()
                    bad.add(ends.get(of[a], of[a]) if len(halves) > 1 and got.startswith(head[: len(got)]) else of[a])
                elif b > a + 1:
                    bad |= {of[a], of[b - 1]}
                elif len(halves) == 1 and word == tokens[a] and word[0].isupper() and len(word) > 4 and not self.plain(word):
                    x = word.strip(EDGE)
                    names[x] += 1
                    where.setdefault(x, set()).add(of[a])
        return out + [(k, "ocr") for k in bad | self.strays(names, where)]

    @staticmethod
    def strays(names: Counter, where: dict[str, set[int]]) -> set[int]:
        """The lines of those names that a more frequent name of the same text with the same strokes is the reading of."""
        forms: dict[str, list[str]] = {}
        for x in names:
            forms.setdefault(skeleton(x.lower()), []).append(x)
        bad: set[int] = set()
        for same in forms.values():
            if len({x.lower() for x in same}) > 1:
                top = max(names[x] for x in same)
                bad = bad.union(*(where[x] for x in same if names[x] < top))
        return bad

    def repair(self, text: str, running: Sequence[int] = ()) -> list[str]:
        """The text's paragraphs, without noise lines, each read by the decoder as one stream; `running`: the lines that are headers as they run."""
        lines = text.split("\n")
        kinds = [("header" if k in running else "title") if kind == "header?" else kind for k, kind in enumerate(self.kinds(lines))]
        keep = [k for k, kind in enumerate(kinds) if kind in ("text", "title")]
        out = []
        for numbers in self.paragraphs(lines, kinds, keep):
            tokens, _ = self.stream(lines, numbers)
            read: list[str] = []
            at = 0
            for a, b, word, _ in self.read(tokens):
                read += tokens[at:a]
                read.append(word)
                at = b
            out.append(" ".join(read + tokens[at:]))
        return out


def lexicon(chunks: DataFrame, rate: float = RATE, reports: float = REPORTS) -> tuple[dict[str, int], frozenset[str], int]:
    """(words, headings, total): the words that make up at least `rate` of all, and the lines in `reports` of all reports.

    Counted over all rows. By their definition there are at most 1 / rate words, whatever the size of the input, so they may
    go to the driver and to every worker.
    """
    counted = chunks.select("chunk_text", F.col("report_id").cast("string").alias("report_id")).mapInPandas(_counts, "kind string, key string, report string, n long")
    by = counted.groupBy("kind", "key", "report").agg(F.sum("n").alias("n")).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    n_reports = max(1, chunks.select(F.approx_count_distinct("report_id")).head()[0])
    by = cut(by.where((F.col("kind") == "t") | (F.col("kind") == "w") & (F.col("n") >= LEAST) | (F.col("kind") == "h") & (F.col("r") >= max(LEAST_REPORTS, reports * n_reports))))
    total = by.where("kind = 't'").agg(F.sum("n")).head()[0] or 0
    rows = by.where((F.col("kind") == "h") | (F.col("kind") == "w") & (F.col("n") >= max(LEAST, rate * total))).select("kind", "key", "n").collect()
    return {r["key"]: r["n"] for r in rows if r["kind"] == "w"}, frozenset(r["key"] for r in rows if r["kind"] == "h"), total


_kept: list = [None, None]


def _reader(token: str, shared) -> Reader:  # noqa: ANN001
    """This worker's reader of a broadcast lexicon, built once. Workers serve one query after another: `token` names the lexicon."""
    if _kept[0] != token:
        _kept[:] = [token, Reader(*shared.value)]
    return _kept[1]


_KEYS = "id string, h long, line_no int, kind string, report string, keys array<string>"


def _report() -> Column:
    """The report of a chunk; one of its own where report_id is null or empty."""
    return F.coalesce(F.nullif(F.col("report_id").cast("string"), F.lit("")), F.concat(F.lit("\u0001"), F.coalesce(F.col("id").cast("string"), F.lit(""))))


def _noise(chunks: DataFrame, token: str, shared, only_headers: bool = False) -> DataFrame:  # noqa: ANN001
    """(id, h, line_no, kind, report, keys), each row once, h the hash of the text; headers, and lines that may be, have their running_keys. Runs at once."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(token, shared)
        for batch in batches:
            rows = []
            for i, h, text, report in zip(batch.id, batch.h, batch.chunk_text, batch.report):
                if not text or only_headers and "\n" not in text:
                    continue
                lines = text.split("\n")
                for k, kind in enumerate(reader.kinds(lines)) if only_headers else reader.find(text):
                    if kind.startswith("header"):
                        rows.append((i, h, k, kind, report, running_keys(lines[k].strip())))
                    elif not only_headers:
                        rows.append((i, h, k, kind, None, None))
            yield pd.DataFrame(rows, columns=["id", "h", "line_no", "kind", "report", "keys"])

    h = F.xxhash64("chunk_text") if only_headers else F.lit(0).cast("long")
    return cut(chunks.select("id", h.alias("h"), "chunk_text", _report().alias("report")).mapInPandas(found, _KEYS).distinct())


def _runs(found: DataFrame) -> DataFrame:
    """(id, h, line_no) of the lines in doubt that stand in RUNNING places of their report, alike but for a word."""
    keyed = found.where("keys IS NOT NULL").select("id", "h", "line_no", "kind", "report", F.explode("keys").alias("key"))
    often = keyed.groupBy("report", "key").agg(F.count("*").alias("n")).where(F.col("n") >= RUNNING).select("report", "key")
    return keyed.where("kind = 'header?'").join(often, ["report", "key"], "left_semi").select("id", "h", "line_no").distinct()


def find_noise(chunks: DataFrame) -> DataFrame:
    """(id, line_no, kind): one row for each kind of noise in each line of chunk_text.

    line_no counts the lines between line feeds from 0. kind is header, page_no, hyphen or ocr (a misread word or number in
    running text). Lines of text are put into paragraphs, and the decoder reads each paragraph's de-lined stream. A line in
    doubt is a header if it runs through its report; a null or empty report_id is no report. Null and empty texts have none.
    Repeated ids count once. Other columns than id, chunk_text and report_id are ignored. Counting words and finding lines
    run when this is called; what is returned reads their results.
    """
    token, shared = uuid.uuid4().hex, chunks.sparkSession.sparkContext.broadcast(lexicon(chunks))
    found = _noise(chunks, token, shared)
    runs = _runs(found).select("id", "line_no", F.lit("header").alias("kind"))
    return found.where("kind <> 'header?'").select("id", "line_no", "kind").unionByName(runs)


def repair(chunks: DataFrame) -> DataFrame:
    """(id, paragraph_no, text): the paragraphs of every chunk, in reading order, without noise.

    Of the rows of an id the one created last counts (equal times, or no column created_at: the greater text); rows without
    id are chunks of their own, equal ones once. A chunk of nothing but noise, or without text, has no row. Texts are moved
    once, before they are read.
    """
    token, shared = uuid.uuid4().hex, chunks.sparkSession.sparkContext.broadcast(lexicon(chunks))
    newest = F.struct(*[F.col(c) for c in ("created_at", "chunk_text") if c in chunks.columns])
    key = lambda text: F.coalesce(F.concat(F.lit("i"), F.col("id")), F.concat(F.lit("h"), text)).alias("__key")
    filled = chunks.where("chunk_text <> ''")
    runs = _runs(_noise(filled, token, shared, True)).select(key(F.col("h").cast("string")), F.struct("h", "line_no").alias("at")).groupBy("__key").agg(F.collect_list("at").alias("at"))
    texts = filled.withColumn("__key", key(F.xxhash64("chunk_text").cast("string"))).groupBy("__key").agg(F.max("id").alias("id"), F.max(newest)["chunk_text"].alias("chunk_text"))
    own = F.transform(F.filter("at", lambda x: x["h"] == F.xxhash64("chunk_text")), lambda x: x["line_no"])

    def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(token, shared)
        for batch in batches:
            rows = [(i, k, p) for i, text, run in zip(batch.id, batch.chunk_text, batch.running) for k, p in enumerate(reader.repair(text, () if run is None else set(run)))]
            yield pd.DataFrame(rows, columns=["id", "paragraph_no", "text"])

    return texts.join(runs, "__key", "left").select("id", "chunk_text", own.alias("running")).mapInPandas(repaired, "id string, paragraph_no int, text string")
