"""How true repaired paragraphs are: noise planted in clean ones, and the character errors before and after the repair.

    python tests/llm/fidelity.py FOLDER [N]   # N texts of FOLDER/rag_chunk.parquet in which no noise is found, in noise of four kinds
"""

from __future__ import annotations

import random
import re
import sys
import textwrap

import numpy as np

#: Signs that the planted noise puts for others; the first of each are not in the decoder's strokes.
SWAPS = [("rn", "m"), ("m", "rn"), ("e", "c"), ("c", "e"), ("o", "0"), ("l", "1"), ("i", "l"), ("h", "b"), ("s", "5"), ("a", "@"), ("u", "ii"), ("t", "f")]


def spoil(paragraphs: list[str], rnd: random.Random, words: float = 0.02, hyphens: float = 0.5, blanks: float = 0.005, width: int = 72, gaps: bool = True) -> str:
    """Paragraphs as a scanner would give them: lines, words cut at their ends, misread letters, blanks within words, headers and page numbers."""
    lines: list[str] = []
    for p in paragraphs:
        tokens = []
        for t in p.split(" "):
            low = t.strip(".,;:()")
            if low.isalpha() and low.islower() and len(low) > 4 and rnd.random() < words:
                swap = [(a, b) for a, b in SWAPS if a in t[1:-1]]
                if swap:
                    a, b = rnd.choice(swap)
                    k = t.index(a, 1)
                    t = t[:k] + b + t[k + len(a) :]
            elif low.isalpha() and low.islower() and len(low) > 6 and rnd.random() < blanks:
                k = rnd.randrange(3, len(low) - 2)
                t = t[:k] + " " + t[k:]
            tokens.append(t)
        made = textwrap.wrap(" ".join(tokens), width, break_on_hyphens=False, break_long_words=False)
        for k in range(len(made) - 1):
            first, *rest = made[k + 1].split(" ", 1)
            if rest and first.isalpha() and first.islower() and len(first) > 6 and rnd.random() < hyphens:
                at = rnd.randrange(3, len(first) - 2)
                made[k], made[k + 1] = f"{made[k]} {first[:at]}-", f"{first[at:]} {rest[0]}"
        lines += [*made, ""] if gaps else made
    for page in range(len(lines) // 25, 0, -1):
        lines[page * 20 : page * 20] = ["", "Survey Report - Northern Block", f"- {page} -", ""]
    return "\n".join(lines)


def distance(a: str, b: str) -> int:
    """Letters put in, left out or replaced between two texts (Levenshtein), one row of the table at a time."""
    x, y = np.frombuffer(a.encode("utf-32-le"), dtype=np.uint32), np.frombuffer(b.encode("utf-32-le"), dtype=np.uint32)
    along = np.arange(len(y) + 1)
    row = along.copy()
    for k, c in enumerate(x, 1):
        new = np.minimum(row[:-1] + (y != c), row[1:] + 1)
        row = np.minimum.accumulate(np.concatenate(([k], new)) - along) + along
    return int(row[-1])


def measure(reader, texts: list[list[str]], seed: int = 1, gaps: bool = True) -> dict[str, float]:
    """Shares of wrong characters before and after, and of paragraphs' ends that are found and that are right."""
    rnd = random.Random(seed)
    before = after = size = ends = found = both = 0
    for paragraphs in texts:
        noisy = spoil(paragraphs, rnd, gaps=gaps)
        got = reader.repair(noisy, [k for k, line in enumerate(noisy.split("\n")) if line.startswith("Survey Report")])
        want = "\n".join(paragraphs)
        plain = "\n".join(re.sub(r"\s+", " ", p).strip() for p in (re.split(r"\n\s*\n", noisy) if gaps else [noisy]) if p.strip())
        before, after, size = before + distance(want, plain), after + distance(want, "\n".join(got)), size + len(want)
        own, theirs = {p[-25:] for p in paragraphs}, {p[-25:] for p in got}
        ends, found, both = ends + len(own), found + len(theirs), both + len(own & theirs)
    return {"before": before / size, "after": after / size, "ends_found": both / ends, "ends_right": both / found}


def main(folder: str, n: int = 400) -> None:
    from strata import session
    from strata.llm import noise
    from strata.util import table

    spark = session.build("fidelity", "local[8]", spark__ui__enabled="false")
    chunks = table(spark, folder, "rag_chunk")
    reader = noise.Reader(*noise.lexicon(chunks))
    noisy = noise.find_noise(chunks).select("id").distinct()
    clean = chunks.where("chunk_text LIKE '%. %' AND doc_type <> 'tabular_row' AND length(chunk_text) BETWEEN 600 AND 4000").join(noisy, "id", "left_anti")
    texts = []
    for r in clean.orderBy("id").select("chunk_text").collect():
        paragraphs = [p for p in (re.sub(r"\s+", " ", x).strip() for x in re.split(r"\n\s*\n", r.chunk_text)) if len(p) > 80 and p[-1] == "." and "\t" not in p and max(map(len, p.split())) < 30]
        if len(paragraphs) > 1:
            texts.append(paragraphs)
    for gaps in (True, False):
        print(f"{len(texts[:n])} texts, blank lines between paragraphs: {gaps}", measure(reader, texts[:n], gaps=gaps))


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests", 1)[0])
    main(sys.argv[1], *map(int, sys.argv[2:]))
