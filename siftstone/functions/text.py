"""Text rules as column expressions: white space, taxonomy, boilerplate, templates, headings, metadata, file names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftstone.functions.columns import digest
from siftstone.functions.python import fold, normalize_url

#: White space as str.split() takes it, and word signs (letters, numbers, underscore; no combining marks).
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def squash(text: Column) -> Column:
    """Runs of white space become one blank, outer ones go."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def normal(text: Column) -> Column:
    """NFKC, casefold, squash; null is empty."""
    return squash(fold(text))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def hits(text: Column, phrases: Sequence[str]) -> Column:
    """How many of the phrases occur."""
    return sum((F.contains(text, F.lit(p)).cast("int") for p in phrases), F.lit(0))


# Identities

def record_id(crawl: Column, source: Column, url: Column, date: Column, paragraph: Column) -> Column:
    """One captured paragraph; later captures of the same page are others."""
    return digest(crawl, F.replace(source, F.lit("\\"), F.lit("/")), normalize_url(url), date, normal(paragraph))


def document_id(crawl: Column, source: Column, url: Column, date: Column, index: Column) -> Column:
    return digest(crawl, F.replace(source, F.lit("\\"), F.lit("/")), normalize_url(url), date, index)


def content_fingerprint(url: Column, paragraph: Column) -> Column:
    return digest(normalize_url(url), normal(paragraph))


def text_fingerprint(text: Column) -> Column:
    return digest(normal(text))


def concept_cluster(concept: Column) -> Column:
    return F.substring(text_fingerprint(concept), 1, 16)


# Domains and taxonomy

def domain_matches(domain: Column, candidates: Sequence[str]) -> Column:
    """The domain ends with a candidate, or holds one that itself ends with a dot."""
    out = F.lit(False)
    for c in candidates:
        out = out | (F.contains(domain, F.lit(c)) if c.endswith(".") else F.endswith(domain, F.lit(c)))
    return out


ADULT = ("asstr.org", "literotica.com", "storiesonline.net")
LYRICS = ("azlyrics.com", "genius.com", "lyricsmode.com", "metrolyrics.com", "ohhla.com", "sing365.com")
POETRY = ("allpoetry.com", "poemhunter.com", "poetrysoup.com")
SHOPS = ("amazon.", "ebay.", "etsy.com", "tripadvisor.")
FAMILY = ("ancestry.com", "familysearch.org", "genealogy.com")
#: (category, domains, phrases, phrases needed, flag, confidence by domain and by phrases, name of the evidence); the first that holds decides.
LADDER = (
    ("adult_content", ADULT, ("adult sex story", "erotic story"), 1, "sensitive", 0.99, 0.82, None),
    ("lyrics", LYRICS, ("lyrics by", "song lyrics", "source: http://www.sing365.com"), 2, "creative_work", 0.99, 0.86, "lyrics"),
    ("poetry", POETRY, ("poem by", "poetry contest", "published poem", "read my poem"), 2, "creative_work", 0.98, 0.78, "poetry"),
    ("commercial", SHOPS, ("add to cart", "book your stay", "buy now", "customer reviews", "free shipping", "sale price"), 2, "commercial", 0.94, 0.82, "commercial"),
    ("genealogy", FAMILY, ("ancestry record", "died on", "family tree", "genealogy record", "married on", "was born on"), 2, "reference_material", 0.96, 0.78, "genealogy"),
)
LYRIC_MARK = r"(?i)\[(?:verse|chorus|bridge|hook|intro|outro)(?:\s+\d+)?\]"


def content_class(text: Column, folded: Column, domain: Column) -> Column:
    """struct(category, confidence, flags, reasons). folded: normal(text); domain: of the page."""
    return bound(folded, lambda once: _class(text, once, domain))


def _class(text: Column, folded: Column, domain: Column) -> Column:
    out = None
    for category, domains, phrases, needed, flag, by_domain, by_phrase, evidence in LADDER:
        listed, count = domain_matches(domain, domains), hits(folded, phrases)
        if category == "lyrics":
            count = count + (F.contains(text, F.lit("[")) & text.rlike(LYRIC_MARK)).cast("int") + (F.contains(folded, F.lit("album:")) & F.contains(folded, F.lit("artist:"))).cast("int")
        reason = F.lit("adult_source_or_marker") if evidence is None else F.when(listed, f"{evidence}_source").otherwise(f"{evidence}_markers")
        value = F.struct(F.lit(category).alias("category"), F.when(listed, by_domain).otherwise(by_phrase).alias("confidence"), F.array(F.lit(flag), F.lit("exclude_from_default_curated")).alias("flags"), F.array(reason).alias("reasons"))
        out = F.when(listed | (count >= needed), value) if out is None else out.when(listed | (count >= needed), value)
    plain = F.struct(F.lit("personal_prose").alias("category"), F.lit(0.72).alias("confidence"), F.array().cast("array<string>").alias("flags"), F.array(F.lit("no_exclusion_signals")).alias("reasons"))
    return out.otherwise(plain)


# Templates and boilerplate

URL = r"(?i)https?://[^\s\x0b\x1c-\x1f\x85\p{Z}]+|www\.[^\s\x0b\x1c-\x1f\x85\p{Z}]+"


def may_link(folded: Column) -> Column:
    """A cheap test that no text with a URL fails; the pattern itself is slow."""
    return F.contains(folded, F.lit("http")) | F.contains(folded, F.lit("www."))


def template_fingerprint(text: Column) -> Column:
    """SHA-256 of the normal text after URLs, then e-mail addresses, then numbers are masked."""
    masked = bound(normal(text), lambda plain: F.when(may_link(plain), F.regexp_replace(plain, URL, "<url>")).otherwise(plain))
    masked = bound(masked, lambda x: F.when(F.contains(x, F.lit("@")), F.regexp_replace(x, r"(?U)\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b", "<email>")).otherwise(x))
    masked = bound(masked, lambda x: F.when(x.rlike(r"\p{Nd}"), F.regexp_replace(x, r"(?U)\b\d+(?:[.,:/-]\d+)*\b", "<number>")).otherwise(x))
    return F.sha2(masked, 256)


BOILER = {
    "navigation": (3, ("back to top", "home about contact", "main menu", "navigation", "next post", "previous post", "skip to content"), 2),
    "policy": (2, ("accept cookies", "all rights reserved", "cookie policy", "privacy policy", "terms and conditions"), 1),
    "promotion": (2, ("add to cart", "buy now", "limited time offer", "sign up for our newsletter", "subscribe to our newsletter"), 1),
    "post_metadata": (2, ("filed under", "leave a comment", "posted in", "related posts", "share this post"), 2),
}
WEIGHTS = {name: weight for name, (weight, *_) in BOILER.items()} | {"link_heavy": 2, "low_lexical_diversity": 2, "repeated_lines": 3}
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def boilerplate_features(text: Column) -> Column:
    """Sorted as listed in WEIGHTS: array of the signals that hold. The text is folded once, in Python; all else stays in the JVM."""

    def flags(plain: Column, words: Column, lines: Column) -> Column:
        found = [F.when(hits(plain, phrases) >= needed, F.lit(name)) for name, (_, phrases, needed) in BOILER.items()]
        found.append(F.when(may_link(plain) & (F.regexp_count(text, F.lit(URL)) >= 4), F.lit("link_heavy")))
        found.append(F.when((F.size(words) >= 60) & (F.size(F.array_distinct(words)) / F.size(words) < 0.28), F.lit("low_lexical_diversity")))
        found.append(F.when((F.size(lines) >= 6) & (F.size(F.array_distinct(lines)) / F.size(lines) < 0.6), F.lit("repeated_lines")))
        return F.array_compact(F.array(*found))

    def signals(folded: Column) -> Column:
        lines = F.filter(F.transform(F.split(folded, LINE_END), squash), lambda x: x != "")
        return bound(squash(folded), lambda plain: bound(tokens(plain), lambda words: bound(lines, lambda own: flags(plain, words, own))))

    return bound(fold(text), signals)


def boilerplate_score(features: Column) -> Column:
    return F.aggregate(features, F.lit(0), lambda s, f: s + sum((F.when(f == n, w).otherwise(0) for n, w in WEIGHTS.items()), F.lit(0)))


# Sentences, headings, metadata

SENTENCE = "[.!?\\u3002\\uff01\\uff1f]+(?:[\"'\\u201d\\u2019)\\]]+)?"


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SENTENCE))


def heading(text: Column) -> Column:
    """Blank, a ruler, or a short line without a sentence that is prefixed, a salutation, mostly capital or title case."""
    value = squash(text)
    words = F.regexp_extract_all(value, F.lit(rf"{WORD}(?:[\p{{L}}\p{{N}}_'’-]*{WORD})?"), F.lit(0))
    letters, capitals = F.length(F.regexp_replace(value, r"\P{L}", "")), F.length(F.regexp_replace(value, r"[^\p{Lu}]", ""))
    title = F.size(F.filter(words, lambda w: F.substring(w, 1, 1).rlike(r"^[\p{Lu}]")))
    n = F.size(words)
    prefixed = value.rlike("(?i)^(?:appendix|book|chapter|contents?|part|references?|section)\\b") | value.rlike("(?i)^(?:dear|hello|hi|to whom it may concern)\\b.{0,100}[:,]?$")
    shaped = prefixed | ((letters > 0) & (capitals / letters >= 0.75)) | ((n >= 2) & (title / n >= 0.8))
    short = (F.length(value) <= 120) & (sentence_count(value) == 0) & n.between(1, 14)
    return (value == "") | value.rlike("^(?:[-=_*#~]\\s*){3,}$") | (short & shaped)


def introduces_document(text: Column) -> Column:
    value = squash(text)
    return F.endswith(value, F.lit(":")) & value.rlike("(?iU)\\b(?:attached|enclosed|following|received|responded|wrote)\\b.*\\b(?:article|email|letter|message|report)\\b")


_NAME = r"[A-Z][\w'’-]*(?:\s+[A-Z][\w'’-]*){0,%d}"
PLACE = r"(?U)\b(?:[Bb]orn|[Cc]ame|[Gg]rew up|[Ll]eft|[Ll]ived|[Mm]oved|[Rr]aised|[Rr]eturned|[Ss]tayed)\s+(?:at|from|in|near|to)\s+(" + _NAME % 4 + ")"
ROUTE = r"(?U)\b(?:[Cc]ame|[Ee]migrated|[Ff]led|[Mm]igrated|[Mm]oved|[Tt]ravell?ed|[Ww]ent)?\s*[Ff]rom\s+(" + _NAME % 3 + r")\s+[Tt]o\s+(" + _NAME % 3 + ")"
TIMES = r"(?iU)\b(?:after \d+ years?|before I left|during my childhood|growing up|in my youth|months? ago|when I was (?:a child|young)|when we moved|years? ago)\b"


def story_metadata(text: Column, date: Column) -> Column:
    """struct of places, years, decades, time phrases, routes, capture year and confidence, as regular expressions find them."""
    edge = lambda x: F.regexp_replace(x, r"^[ ,.;:!?]+|[ ,.;:!?]+$", "")
    every = lambda pattern, group=0, if_=F.lit(True): F.when(if_, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))
    dated, routed = hits(text, ("18", "19", "20")) > 0, F.contains(text, F.lit("rom"))  # cheap tests that no match fails
    years = F.array_sort(F.array_distinct(F.transform(every(r"(?U)\b(?:18|19|20)\d{2}\b", if_=dated), lambda y: y.cast("int"))))
    decades = F.array_sort(F.array_distinct(F.transform(every(r"(?iU)\b(?:18|19|20)\d0s\b", if_=dated), F.lower)))
    times = F.transform(F.array_sort(F.transform(F.array_distinct(every(TIMES)), lambda t: F.struct(F.lower(t).alias("low"), t.alias("t")))), lambda s: s["t"])
    named = F.filter(F.transform(every(PLACE, 1), edge), lambda p: (F.length(p) >= 2) & ~F.lower(p).isin("home", "school", "town"))
    trips = F.filter(F.zip_with(F.transform(every(ROUTE, 1, routed), edge), F.transform(every(ROUTE, 2, routed), edge), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda r: F.lower(r["a"]) != F.lower(r["b"]))
    places = F.array_distinct(F.concat(named, F.flatten(F.transform(trips, lambda r: F.array(r["a"], r["b"])))))
    routes = F.array_distinct(F.transform(trips, lambda r: F.concat(r["a"], F.lit(" -> "), r["b"])))
    year = F.nullif(F.regexp_extract(F.coalesce(date, F.lit("")), r"(?U)\b(?:18|19|20)\d{2}\b", 0), F.lit("")).cast("int")
    kinds = sum(((F.size(x) > 0).cast("int") for x in (places, years, decades, times, routes)), F.lit(0))
    confidence = F.least(F.lit(0.95), 0.25 + 0.15 * kinds + 0.1 * (F.size(routes) > 0).cast("int") + 0.05 * (F.size(years) > 1).cast("int"))
    return F.struct(places.alias("place_mentions"), years.alias("year_mentions"), decades.alias("decade_mentions"), times.alias("time_expressions"), routes.alias("migration_routes"), year.alias("capture_year"), F.when(kinds > 0, F.round(confidence, 4)).otherwise(0.0).alias("metadata_confidence"))


# Names of files and partitions

def safe_name(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9._-]+", "_")


def source_digest(source: Column, size: int = 16) -> Column:
    return F.substring(F.sha2(source, 256), 1, size)


def shard_name(source: Column) -> Column:
    """Name of a source's shard: digest of the whole path and its last part without .gz."""
    base = F.regexp_replace(F.element_at(F.split(source, r"[/\\]"), -1), "\\.gz$", "")
    return F.concat(source_digest(source), F.lit("_"), safe_name(base), F.lit(".jsonl.gz"))


def old_shard_name(source: Column) -> Column:
    """The earlier scheme: the path with its separators replaced."""
    return F.concat(F.regexp_replace(F.translate(source, "/\\", "__"), "\\.gz$", ""), F.lit(".jsonl.gz"))


def safe_language(language: Column) -> Column:
    return F.when(language.rlike("^[A-Za-z0-9_-]{1,20}$"), language).otherwise(F.lit("unknown"))


def count_label(count: Column, noun: str) -> Column:
    return F.concat(count.cast("string"), F.lit(f" {noun}"), F.when(count == 1, "").otherwise("s"))


def match_label(numbers: Column) -> Column:
    return F.when(F.size(numbers) == 1, F.concat(F.lit("Match "), numbers[0].cast("string"))).otherwise(F.concat(F.lit("Matches "), F.array_join(F.transform(numbers, lambda x: x.cast("string")), ", ")))


def blockquote(text: Column) -> Column:
    lines = F.transform(F.split(F.regexp_replace(text, f"(?:{LINE_END})\\z", ""), LINE_END), lambda x: F.regexp_replace(x, f"{SPACE}+$", ""))
    return F.array_join(F.transform(lines, lambda x: F.when(x == "", F.lit(">")).otherwise(F.concat(F.lit("> "), x))), "\n")
