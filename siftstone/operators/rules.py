"""The filter rules: keywords, narrative voice, navigation, repetition, decisions and language routing."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType, StructType

from siftstone.functions import vocabulary
from siftstone.functions.python import by_slices
from siftstone.functions.text import WORD, bound
from siftstone.functions.vocabulary import items

#: Blocks of scripts that do not part words by blanks: Thai, Hangul, Hiragana, Katakana, Bopomofo to CJK, and their compatibility forms.
UNPARTED = "[\\u0e00-\\u0e7f\\u1100-\\u11ff\\u2e80-\\u2fdf\\u3040-\\u318f\\u31a0-\\u9fff\\ua960-\\ua97f\\uac00-\\ud7ff\\uf900-\\ufaff\\uff65-\\uffdc]"


def whole_word(keyword: str, most: int = 4) -> bool:
    """Short keywords of scripts that part words count only as whole words."""
    import re

    return len(keyword) <= most and not re.search(UNPARTED, keyword)


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """Sorted keywords in the text: long ones anywhere in it, lower-cased; short ones as whole words. For short lists; keyword_finder() takes hundreds."""
    low = F.lower(text)
    found = [F.when(low.rlike(f"(?<!{WORD})\\Q{k}\\E(?!{WORD})") if whole_word(k) else F.contains(low, F.lit(k)), F.lit(k)) for k in sorted(keywords)]
    return F.array_compact(F.array(*found))


def keyword_finder(keywords: Sequence[str]):
    """The same for a vocabulary of any size: one pass of an automaton over each text, in Arrow batches."""
    short = frozenset(k for k in keywords if whole_word(k))
    words = tuple(keywords)

    @pandas_udf(ArrayType(StringType()))
    def find(texts: pd.Series) -> pd.Series:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for w in words:
            machine.add_word(w, w)
        machine.make_automaton()
        inside = lambda c: c.isalnum() or c == "_"

        def one(text: str | None) -> list[str]:
            low = (text or "").lower()
            out = set()
            for end, w in machine.iter(low):
                if w not in out:
                    start = end + 1 - len(w)
                    if w not in short or not ((start and inside(low[start - 1])) or (end + 1 < len(low) and inside(low[end + 1]))):
                        out.add(w)
            return sorted(out)

        return texts.map(one)

    return find


def _reader():
    """What the rules look for in a lower-cased text, found in one pass of an automaton over its phrases and one over its words."""
    import re
    from collections import Counter

    import ahocorasick

    of: dict[str, list[str]] = {}
    for kind, phrases in (("hard", vocabulary.HARD), ("navigation", vocabulary.NAVIGATION), ("told", vocabulary.NARRATIVE), ("soft", vocabulary.SOFT)):
        for p in items(phrases):
            of.setdefault(p, []).append(kind)
    machine = ahocorasick.Automaton()
    for p in of:
        machine.add_word(p, p)
    machine.make_automaton()
    names, twice, word = frozenset(items(vocabulary.FIRST_PERSON)), vocabulary.TWICE, re.compile(r"\w+")
    several = [(p, re.compile(rf"(?<!\w){re.escape(p)}(?!\w)")) for p in items(vocabulary.FIRST_PERSON_PHRASES)]

    def read(low: str | None) -> dict | None:
        if low is None:
            return None
        found = Counter(kind for p in {p for _, p in machine.iter(low)} for kind in of[p])
        words, repetitive = low.split(), False
        if len(words) > 50:
            grams = len(words) - 3
            repetitive = 1 - len(set(zip(words[:grams], words[1:], words[2:]))) / grams > 0.25
        own = Counter(w for w in word.findall(low) if w in names)
        points = sum(min(4, n) * (2 if w == twice else 1) for w, n in own.items()) + sum(min(4, len(x.findall(low))) for p, x in several if p in low)
        return {"hard": found["hard"] > 0, "navigation": found["navigation"], "repetitive": repetitive, "points": points + 3 * found["told"] - 2 * found["soft"]}

    return read


_read = by_slices(_reader, StructType().add("hard", "boolean").add("navigation", "integer").add("repetitive", "boolean").add("points", "integer"), load=True)


def reading(text: Column) -> Column:
    """struct(hard: an institutional or commercial phrase; navigation: how many names of months and languages; repetitive; points of words and phrases)."""
    return _read(F.lower(text))


def navigation_or_form(text: Column) -> Column:
    """Five or more names of months and languages, many signs, or many colons or bars."""
    n = F.length(text)
    signs = F.length(F.regexp_replace(text, r"[a-zA-Z0-9\s\p{L}\p{N}\x0b\x1c-\x1f\x85\p{Z}]+", ""))
    colons, bars = (n - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in ":|")
    return (reading(text)["navigation"] >= 5) | (colons > 5) | (bars > 5) | ((n > 100) & (signs / n > 0.15))


def repetitive(text: Column) -> Column:
    """More than 50 words, of whose trigrams (the last one is never built) more than a quarter repeat."""
    return reading(text)["repetitive"]


LYRIC_MARKS = r"(?i)\[verse \d+\]|\[(?:bridge|chorus|intro|outro)\]|\((?:bridge|chorus|verse)\)"


def rejected(text: Column) -> Column:
    """What no score outweighs: institutional and commercial phrases, lyric marks, repetition, navigation."""
    lyrics = (F.contains(text, F.lit("[")) | F.contains(text, F.lit("("))) & text.rlike(LYRIC_MARKS)
    return reading(text)["hard"] | repetitive(text) | lyrics | navigation_or_form(text)


def marker_points(text: Column) -> Column:
    """Points of first-person markers of other scripts: at most three each, the longer ones first, no sign counted twice but blanks.

    A counted marker's signs are struck out, so that a shorter one inside it finds nothing. Texts of Latin letters only take no step of it.
    """
    order = sorted(items(vocabulary.MARKERS), key=lambda m: (-len(m), m))
    struck = ["".join(c if c.isspace() else "\x00" for c in m) for m in order]
    markers = F.array(*[F.struct(F.lit(f"\\Q{m}\\E").alias("p"), F.lit(s).alias("s")) for m, s in zip(order, struck)])

    def step(state: Column, m: Column) -> Column:
        return bound(F.split(state["rest"], m["p"], 4), lambda parts: F.struct((state["points"] + F.size(parts) - 1).alias("points"), F.call_function("array_join", parts, m["s"]).alias("rest")))

    start = F.struct(F.lit(0).alias("points"), F.lower(text).alias("rest"))
    return F.when(text.rlike("[^\\x00-\\u036f]"), F.aggregate(markers, start, step)["points"]).otherwise(0)


def narrative_score(text: Column) -> Column:
    """Points of a first-person narrative: four at most for each word, markers, three a phrase, two off for each soft negative; -50 if rejected()."""
    return F.when(rejected(text), F.lit(-50)).otherwise(reading(text)["points"] + marker_points(text))


SKIPPED = "pre-filtered boilerplate"


def decision(score: Column, narrative: Column, threshold: float = 0.45, least: int = 8) -> Column:
    """Why a candidate is rejected, or 'accepted'."""
    return F.when(narrative <= -50, "boilerplate_pre_filter").when(score < threshold, "semantic_threshold").when(narrative < least, "narrative_threshold").otherwise("accepted")


def routed(language: Column, confidence: Column, threshold: float = 0.5) -> Column:
    """The language where the model is sure enough and the name is plain; else unknown."""
    return F.when((confidence >= threshold) & language.rlike("^[A-Za-z0-9_-]{1,20}$"), language).otherwise(F.lit("unknown"))
