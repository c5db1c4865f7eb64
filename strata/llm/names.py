"""Linking the spellings of one company or person."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.util import cut, sized_join

#: Words that make up company names besides the name proper, by class, and short forms no rule yields. They are a
#: start: general_words() adds those that a corpus shows to be general.
LEGAL = "ltd limited ltee limitee inc incorporated incorporee corp corporation co company compagnie cie llc lp plc holdings group groupe operator".split()
PLACE = "lake bay mountain star creek ridge river island point narrows township hill falls harbour lac riviere ontario alberta yukon quebec manitoba saskatchewan british columbia nova scotia brunswick newfoundland labrador nunavut canada north south east west".split()
TRADE = "gold silver copper zinc nickel lithium uranium iron platinum cobalt diamond potash graphite mines mining minerals metals resources ventures exploration explorations development developments prospecting syndicate energy royalty geological services consulting societe miniere minier metaux ressources mineraux or cuivre".split()
SHORT = {
    "lk": "lake", "mt": "mountain", "mtn": "mountain", "ck": "creek", "crk": "creek", "r": "river", "riv": "river", "rdg": "ridge", "isl": "island", "twp": "township",
    "au": "gold", "ag": "silver", "cu": "copper", "zn": "zinc", "ni": "nickel", "li": "lithium", "u": "uranium", "fe": "iron", "co": "company",
    "mng": "mining", "minls": "minerals", "min": "minerals", "expln": "exploration", "explorn": "exploration", "res": "resources", "ress": "ressources", "soc": "societe",
    "bc": "british", "ont": "ontario", "alb": "alberta", "alta": "alberta", "yuk": "yukon", "que": "quebec", "man": "manitoba", "sask": "saskatchewan", "ns": "nova",
}
#: Short forms of a place word and of a trade word; the family tells which, see _companies().
EITHER = {"pt": ("point", "platinum")}
DROPPED = frozenset("the of de du des la le les l d and et no mr mrs ms miss dr m messrs".split())
NOBODY = frozenset("unknown inconnu inconnue none null nil na n/a nan tba tbd various divers several confidential anonymous anonyme unnamed untitled test same see not".split())
#: Given names and the familiar forms of each.
GIVEN = {
    "alexander": "alex sandy al", "anthony": "tony", "arthur": "art", "benoit": "ben", "benjamin": "ben", "catherine": "cathy kate katie kathy", "charles": "charlie chuck", "daniel": "dan danny",
    "david": "dave", "donald": "don", "dorothy": "dot dottie", "edward": "ed ted eddie ned", "elizabeth": "liz betty beth lizzie", "francis": "frank", "frederick": "fred freddie", "george": "", "gerard": "gerry",
    "gerald": "gerry jerry", "harold": "harry hal", "henry": "hank harry", "james": "jim jimmy", "jean": "", "jeanpierre": "jp", "john": "jack johnny", "joseph": "joe", "kenneth": "ken", "lawrence": "larry",
    "leonard": "len", "louis": "lou", "margaret": "peggy maggie meg", "marie": "", "mary": "molly", "michael": "mike mick", "michel": "", "nicholas": "nick", "patricia": "pat trish patty", "patrick": "pat paddy", "paul": "", "peter": "pete",
    "philip": "phil", "pierre": "", "ralph": "", "raymond": "ray", "richard": "dick rick rich", "robert": "bob rob bobby", "ronald": "ron", "samuel": "sam", "stephen": "steve", "susan": "sue", "theodore": "ted theo",
    "thomas": "tom tommy", "victor": "vic", "walter": "walt wally", "william": "bill will billy",
}
_GENERIC = {**{w: "legal" for w in LEGAL}, **{w: "place" for w in PLACE}, **{w: "trade" for w in TRADE}}
_FAMILIAR: dict[str, set[str]] = {}
for _formal, _forms in GIVEN.items():
    for _form in (_formal, *_forms.split()):
        _FAMILIAR.setdefault(_form, set()).add(_formal)
_consonants = re.compile(r"[aeiouy]").sub

#: The least likeness, twice the longest common subsequence over both lengths, of two spellings of one word.
LIKE = 0.8
#: Letters by which two spellings may differ, a replaced one counting twice; for long words this is stricter than LIKE.
EDITS = 3
#: Suffixes shorter than this are looked at only together with the other fields.
SUFFIX = 4
#: Words a suffix may have before it is refined with the other fields, and before a refined one is compared by what is left of its words without some letters.
COMMON = 60
#: Letters between the first and the last up to which a word is compared so; longer ones by their parts.
LONG = 20
#: Words whose keys a task holds at once in that comparison.
AT_ONCE = 50


def lcs_ratio(a: str, b: str) -> float:
    """Twice the length of the longest common subsequence over the sum of both lengths."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            above = row[j]
            row[j] = before + 1 if x == y else (above if above >= row[j - 1] else row[j - 1])
            before = above
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


#: A word is general if it stands in this share of all different names, and in LEAST of them, beside so many other words for each.
GENERAL, LEAST, BESIDE = 0.005, 30, 0.25
_known: dict[tuple[str, frozenset], str] = {}


def words_of(name: str) -> list[str]:
    """The words of a name in lower case without accents and apostrophes, and its commas."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    return re.findall(r"[a-z0-9]+|,", re.sub(r"\bjean[- ]pierre\b", "jeanpierre", plain).replace("'", "").replace("’", ""))


def general_words(values: DataFrame) -> frozenset[str]:
    """Words of many different names that belong to no family: they stand beside many others, as the words of one name don't.

    Given names, the words of the lists and short forms aren't among them. There are at most some hundred, by the share that each has of
    all names; they go to the driver.
    """

    @F.pandas_udf("array<string>")
    def split(names: pd.Series) -> pd.Series:
        return names.map(lambda n: sorted({w for w in words_of(n) if len(w) > 2 and not w.isdigit()}))

    names = cut(values.select(split("company").alias("ws")))
    least = max(LEAST, math.ceil(GENERAL * names.count()))
    counted = names.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    beside = names.select("ws", F.explode("ws").alias("w")).join(F.broadcast(counted), "w").select("w", "n", F.explode("ws").alias("o")).where("o <> w")  # as many as GENERAL allows
    rows = beside.groupBy("w", "n").agg(F.approx_count_distinct("o").alias("o")).where(F.col("o") >= BESIDE * F.col("n")).collect()
    learned: list[str] = []
    for r in sorted(rows, key=lambda r: (-r["n"], r["w"])):
        w = r["w"]
        # A short or misspelt form of a more frequent general word isn't one of its own.
        if not generic(w, frozenset(learned)) and w not in DROPPED and w not in NOBODY and not formal(w):
            learned.append(w)
    return frozenset(learned)


def generic(token: str, learned: frozenset[str] = frozenset()) -> str:
    """The general word that a token stands for, written out, short or misspelt; '' for a part of the name proper."""
    key = (token, learned)
    if key in _known:
        return _known[key]
    found = token if token in _GENERIC or token in EITHER or token in learned else SHORT.get(token, "")
    if not found and len(token) >= 3:
        for word in (*_GENERIC, *sorted(learned)):
            shorter = len(token) < len(word) and token[0] == word[0]
            if shorter and len(token) <= 6 and (word.startswith(token) or _consonants("", token) == _consonants("", word)) and len(_consonants("", token)) > 1:
                found = word
                break
            if len(token) >= 5 and len(word) >= 5 and abs(len(token) - len(word)) <= 1 and token[0] == word[0] and lcs_ratio(token, word) >= 0.86:
                found = word
                break
    if len(_known) > 500_000:
        _known.clear()
    _known[key] = found
    return found


def formal(token: str) -> set[str]:
    """The given names that a token may stand for, familiar or misspelt; empty if it is none."""
    if token in _FAMILIAR:
        return _FAMILIAR[token]
    if len(token) >= 5:
        return {n for n in GIVEN if len(n) >= 5 and n[0] == token[0] and abs(len(n) - len(token)) <= 1 and lcs_ratio(n, token) >= 0.88}
    return set()


def parse(name: str, learned: frozenset[str] = frozenset()) -> tuple[str, list[str], str, str, list[str]]:
    """(kind, roots, place, trade, given): the parts of a name as typed; kind is org, person or none."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    if plain.strip(" .?-") in NOBODY or re.match(r"\W*(?:not (?:stated|given|known|available|applicable)|see |various |n/?a\b|unknown|none\b|inconnu|sans objet|non (?:indique|precise))", plain):
        return "none", [], "", "", []
    tokens = words_of(name)
    words = [t for t in tokens if t != "," and t not in DROPPED or len(t) == 1 and t != ","]
    if not words or not any(c.isalnum() for c in plain):
        return "none", [], "", "", []
    numbers = [t for t in words if t.isdigit() and len(t) >= 3]
    classed = [(t, generic(t, learned) if len(t) > 1 else "") for t in words]
    joint = "&" in plain or re.search(r"\b(?:and|et)\b", plain)
    if numbers or joint or any(g for _, g in classed):
        out = []
        for t, g in classed:
            if len(t) == 1:
                g = SHORT.get(t, "") if t == "r" else ""
                if not g:
                    continue
            out.append((t, g))
        roots = [t for t, g in out if not g]
        place = " ".join(sorted({g for _, g in out if _GENERIC.get(g) == "place" or g in EITHER}))
        trade = " ".join(sorted({g for _, g in out if _GENERIC.get(g) == "trade" or g in learned}))
        return ("org" if roots else "none"), roots, place, trade, []
    if "," in tokens:
        at = tokens.index(",")
        last, given = [t for t in tokens[:at] if t not in DROPPED], [t for t in tokens[at + 1 :] if t != "," and (t not in DROPPED or len(t) == 1)]
        if last and given:
            return "person", [max(last, key=len)], "", "", given
    long = [t for t in words if len(t) > 1]
    if len(words) == 1 or not long:
        return ("org" if long else "none"), long, "", "", []
    if len(long) == 1:
        return "person", long, "", "", [t for t in words if len(t) == 1]
    names = [t for t in long if formal(t)]
    last = words[0] if (formal(words[-1]) or len(words[-1]) == 1) and not formal(words[0]) and len(words[0]) > 1 else long[-1]
    if not names and len(words) == len(long):
        return "org", long, "", "", []
    return "person", [last], "", "", [t for t in words if t != last]


def _parsed(values: DataFrame, learned: frozenset[str]) -> DataFrame:
    @F.pandas_udf("kind string, roots array<string>, place string, trade string, given array<string>")
    def parsed(names: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(n, learned) for n in names], columns=["kind", "roots", "place", "trade", "given"])

    return values.select("company", parsed("company").alias("p")).select("company", "p.*")


def _remains(m: str, shorter: bool) -> set[str]:
    """Keys of which the shorter and the longer of two words share one if they differ by EDITS letters left out or put in.

    Then the shorter lacks one letter at most of what both have in common, the longer three at most. Of words with more than
    LONG letters the shorter one's parts, one more than EDITS, are looked for in the longer one, EDITS aside at most.
    """
    n, parts, out = len(m), EDITS + 1, set()

    def ends(size: int) -> list[tuple[int, int]]:
        return [(size * k // parts, size * (k + 1) // parts) for k in range(parts)]

    if shorter:
        if n <= LONG:
            return {f"0{m}", *(f"1{m[:k]}{m[k + 1 :]}" for k in range(n))}
        return {f"{n}|{k}|{m[i:j]}" for k, (i, j) in enumerate(ends(n))}
    if n <= LONG + EDITS:
        for gone in range(1, min(EDITS, n) + 1):
            rests = {"".join(x) for x in combinations(m, n - gone)}
            out |= {f"0{x}" for x in rests} | ({f"1{x}" for x in rests} if gone + 1 <= EDITS else set())
    for size in range(max(n - EDITS, LONG + 1), n + 1):
        out |= {f"{size}|{k}|{m[i + d : j + d]}" for k, (i, j) in enumerate(ends(size)) for d in range(-EDITS, EDITS + 1) if i + d >= 0}
    return out


def _near(blocks: DataFrame) -> DataFrame:
    """(a, b): the pairs of words with a common key that may differ by EDITS; in a block all words begin and end with the same letters.

    Words are compared by keys of which each has few words however many there are, so no block is squared. A word has up to
    some 2,300 keys, so they are made for AT_ONCE words at a time, in as many tasks as shuffles have. Spark takes the keys
    for as small as the words they are made of, hence the hint: it would broadcast them through the driver.
    """

    def remains(shorter: bool, word: str) -> DataFrame:
        def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for k in range(0, len(batch), AT_ONCE):
                    rows = [(w, w[0] + w[-1] + r) for w in batch.w.iloc[k : k + AT_ONCE] for r in sorted(_remains(w[1:-1], shorter))]
                    yield pd.DataFrame(rows, columns=[word, "r"])

        return words.mapInPandas(keys, f"{word} string, r string")

    words = blocks.select("w").repartition(spread(blocks), "w").distinct()
    less, more = remains(True, "o"), remains(False, "w")
    pairs = less.hint("merge").join(more, "r").where("o <> w").select(F.least("o", "w").alias("a"), F.greatest("o", "w").alias("b")).where(F.levenshtein("a", "b") <= EDITS).distinct()
    shared = pairs.join(blocks.select(F.col("w").alias("a"), "key"), "a").join(blocks.select(F.col("w").alias("b"), "key"), ["b", "key"])
    return shared.select("a", "b").distinct()


def root_links(parsed: DataFrame) -> DataFrame:
    """(a, b): pairs of words of the name proper that are taken for spellings of one word.

    Suffix blocking: every word is filed under its suffixes of at least SUFFIX characters. A suffix with more than COMMON
    words is refined with the other fields of the name (its place and trade words, or that it is a person's) and the first
    letter; shorter suffixes, for typing errors near the end, are always refined so. Of what is still more common, those pairs
    meet that may differ by EDITS at most. Pairs are kept by the ratio of their longest common subsequence, and if
    they begin with one letter; numbers never are.
    """
    field = F.when(F.col("kind") == "person", F.array(F.lit("person"))).otherwise(F.array(F.concat_ws("|", "place", "trade"), F.concat("place", F.lit("|*"))))
    roots = parsed.where("kind <> 'none'").select(F.explode("roots").alias("w"), field.alias("fs")).where(r"length(w) >= 4 AND NOT w RLIKE '^[0-9]+$'")
    roots = roots.select("w", F.explode("fs").alias("f")).distinct()
    ends = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda k: F.right("w", k))
    filed = roots.select("w", "f", F.explode(ends).alias("s"))
    long = filed.where(F.length("s") >= SUFFIX).select("s", "w").distinct()
    counted = long.hint("merge").join(long.groupBy("s").agg(F.count("*").alias("n")), "s")
    rare = counted.where(F.col("n") <= COMMON).select(F.col("s").alias("key"), "w")
    common = counted.where(F.col("n") > COMMON).select("s").distinct()
    refined = filed.join(common, "s", "left_semi").select("w", "f", "s").unionAll(filed.where(F.length("s") < SUFFIX))
    refined = refined.select(F.concat_ws("~", "s", "f", F.left("w", F.lit(1))).alias("key"), "w").distinct()
    refined = cut(refined.hint("merge").join(refined.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"))
    blocks = rare.unionAll(refined.where(F.col("n") <= COMMON).select("key", "w"))
    left, right = blocks.select("key", F.col("w").alias("a")), blocks.select("key", F.col("w").alias("b"))
    both = left.join(right, "key").where("a < b AND left(a, 1) = left(b, 1)").select("a", "b").unionAll(_near(refined.where((F.col("n") > COMMON) & (F.locate("~", F.col("key")) == 2)).select("key", "w")))
    total = F.length("a") + F.length("b")
    both = both.unionAll(_first_letters(roots.select("w").distinct()))
    both = both.where((F.abs(F.length("a") - F.length("b")) <= EDITS) & (F.levenshtein("a", "b") <= EDITS)).select("a", "b").distinct()

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([lcs_ratio(x, y) for x, y in zip(a, b)], dtype="float64")

    # A word of n letters that differs in its first has the ratio (n - 1) / n or more.
    return both.where(ratio("a", "b") >= F.greatest(F.lit(LIKE), 1 - EDITS / total - 1e-9))


def _first_letters(words: DataFrame) -> DataFrame:
    """(a, b): words of six letters or more whose first letter was replaced, left out, put in or changed for the second."""
    w = words.where("length(w) >= 6")
    rest, swapped = F.substring("w", 2, 10_000), F.concat(F.substring("w", 2, 1), F.substring("w", 1, 1), F.substring("w", 3, 10_000))
    forms = w.select("w", F.explode(F.array(F.struct(F.lit("r").alias("t"), rest.alias("k")), F.struct(F.lit("w").alias("t"), F.col("w").alias("k")))).alias("f")).select("w", "f.*")
    other = w.select(F.col("w").alias("o"), F.explode(F.array(F.struct(F.lit("r").alias("t"), rest.alias("k")), F.struct(F.lit("w").alias("t"), rest.alias("k")), F.struct(F.lit("w").alias("t"), swapped.alias("k")))).alias("f")).select("o", "f.*")
    return forms.hint("merge").join(other, ["t", "k"]).where("w <> o").select(F.least("w", "o").alias("a"), F.greatest("w", "o").alias("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(w, label): the least word that each word of the pairs is linked to, through any number of pairs.

    Labels pass along the pairs and to the label's own label in each round, and what a word hears of goes to its label's word
    too, until nothing changes; rounds are written to the checkpoint folder. Joins are merged: broadcasts of one round after
    the other would fill the driver.
    """
    edges = cut(pairs.select(F.col("a").alias("w"), F.col("b").alias("o")).unionAll(pairs.select(F.col("b").alias("w"), F.col("a").alias("o"))))
    labels = cut(edges.groupBy("w").agg(F.least(F.col("w"), F.min("o")).alias("label")))
    while True:
        near = edges.hint("merge").join(labels.select(F.col("w").alias("o"), "label"), "o").groupBy("w").agg(F.min("label").alias("near"))
        told = labels.hint("merge").join(near, "w").select(F.col("label").alias("w"), "near").unionAll(near.select("w", "near")).groupBy("w").agg(F.min("near").alias("near"))
        jump = labels.select(F.col("w").alias("label"), F.col("label").alias("far"))
        new = cut(labels.hint("merge").join(told, "w").hint("merge").join(jump, "label", "left").select("w", F.col("label").alias("old"), F.least("label", "near", F.coalesce("far", "label")).alias("label")))
        if new.where("label <> old").isEmpty():
            return labels
        labels = new.select("w", "label")


def _people(group: pd.DataFrame) -> list[str]:
    """An entity's name for each row of a family: the given name that the row's given name or initial stands for in it."""
    firsts = [([t for t in g if len(t) > 1] or list(g) or [""])[0] for g in group.given]
    options = [formal(f) or ({f} if len(f) > 1 else set()) for f in firsts]
    present = {next(iter(o)) for o in options if len(o) == 1}
    middles: dict[str, set[str]] = {}
    for given, o in zip(group.given, options):
        if len(o) == 1:
            middles.setdefault(next(iter(o)), set()).update(t for t in given if len(t) == 1)
    starting: dict[str, set[str]] = {}
    for p in present:
        starting.setdefault(p[:1], set()).add(p)
    out = []
    for given, first, o in zip(group.given, firsts, options):
        if len(o) > 1:
            there = o & present
            out.append(next(iter(there)) if len(there) == 1 else "?" + first)
        elif len(o) == 1:
            out.append(next(iter(o)))
        else:
            there = starting.get(first, set())
            rest = set(given[1:])
            if len(there) > 1 and rest:
                there = {p for p in there if rest & middles.get(p, set())} or there
            out.append(next(iter(there)) if len(there) == 1 else "?" + first)
    return out


def _companies(group: pd.DataFrame) -> list[str]:
    """An entity's name for each row of a family: its place and trade words, filled up where only one fuller name has them.

    A name has one fuller one if the names that hold all its words and more make up one of them together.
    """
    plain = {(p, t) for p, t in zip(group.place, group.trade) if not set(p.split()) & set(EITHER)}

    def told(place: str, trade: str) -> tuple[str, str]:
        for short in set(place.split()) & set(EITHER):
            rest, (as_place, as_trade) = [w for w in place.split() if w != short], EITHER[short]
            one = (" ".join(sorted([*rest, as_place])), trade)
            two = (" ".join(rest), " ".join(sorted([*trade.split(), as_trade])))
            place, trade = two if two in plain and one not in plain else one
        return place, trade

    keys = [told(p, t) for p, t in zip(group.place, group.trade)]
    full = {k: (frozenset(k[0].split()), frozenset(k[1].split())) for k in keys}
    known = {v: k for k, v in full.items()}
    by_place: dict[frozenset, list[frozenset]] = {}
    for place, trade in full.values():
        by_place.setdefault(place, []).append(trade)

    def home(key: tuple[str, str]) -> tuple[str, str]:
        place, trade = full[key]
        above = [(place, t) for t in by_place[place] if t > trade]
        if not above and not place and not trade:
            above = [v for v in full.values() if v[0]]
        top = (frozenset().union(*(p for p, _ in above)), frozenset().union(*(t for _, t in above)))
        return known[top] if above and top in known else key

    homes = {k: home(k) for k in full}
    return ["|".join(homes[k]) for k in keys]


def _resolve(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["place", "trade", "first"])
    names = _people(group) if group.kind.iloc[0] == "person" else _companies(group)
    return pd.DataFrame({"family": group.family, "place": group.place, "trade": group.trade, "first": group["first"], "entity": [f"{group.family.iloc[0]}#{n}" for n in names]})


def entities(chunks: DataFrame, column: str = "company") -> DataFrame:
    """(company, entity): each different value of the column with the company or person it names.

    Values that are null, blank, or name nobody have no row. Spellings of one name have the same words of the name proper
    (root_links, through any number of links) and, for companies, the same place and trade words, of which trade words may
    be missing if only one company of the family has them; for people the same given name, which may be familiar or an
    initial if only one person of the family goes by it. Sister companies and relatives stay apart.
    """
    values = cut(chunks.select(F.col(column).alias("company")).where(r"trim(company) <> ''").groupBy("company").agg(F.count("*").alias("n")).select("company"))
    parsed = cut(_parsed(values, general_words(values)).where("kind <> 'none'"))
    labels = components(root_links(parsed))
    words = parsed.select("company", F.explode("roots").alias("w")).join(labels, "w", "left").groupBy("company").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("label", "w"))), " ").alias("roots"))
    family = F.concat_ws(":", F.when(F.col("kind") == "person", "p").otherwise("o"), "r.roots")
    rows = cut(parsed.alias("l").join(words.alias("r"), "company").select("company", "kind", "place", "trade", "given", F.array_join("given", " ").alias("first"), family.alias("family")))
    # A family is resolved by its different words, of which there are few however many its spellings are.
    keys = ["family", "place", "trade", "first"]
    different = rows.groupBy(*keys).agg(F.first("kind").alias("kind"), F.first("given").alias("given")).repartition(spread(rows), "family")
    named = different.groupBy("family").applyInPandas(_resolve, "family string, place string, trade string, first string, entity string")
    return sized_join(rows, named, keys).select("company", "entity")


def spread(df: DataFrame) -> int:
    """Tasks for work in Python on few rows, which would be put together by their size: as many as shuffles have at least."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def linked_pairs(chunks: DataFrame, column: str = "company") -> DataFrame:
    """(company_a, company_b): every two different values that name the same company or person, the lesser first."""
    named = cut(entities(chunks, column))
    left, right = named.select("entity", F.col("company").alias("company_a")), named.select("entity", F.col("company").alias("company_b"))
    return left.join(right, "entity").where("company_a < company_b").select("company_a", "company_b")
