"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans the patterns miss."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.state import released
from siftstone.runtime import table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Possessive runs and look-behinds only spare retries that cannot match, so matches are those of the plain patterns.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SOME = re.compile(r"[0-9@]|\b[Aa][Tt]\b")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start; code points, end exclusive."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 38 and 13 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.DOTALL)
BLANK, DASH = "\x20\t\xa0   ", "‐-―−"
NUMBERS = re.compile(rf"[0-9+(\[][0-9{BLANK}\r\n(){{}}\[\].+/{DASH}-]*")
LABEL = "[A-Za-z0-9-]{1,63}"
STOP = rf"(?:\.|[{BLANK}]?[\[({{<][{BLANK}]?(?:\.|[Dd][Oo][Tt])[{BLANK}]?[\])}}>][{BLANK}]?|[{BLANK}]?\b[Dd][Oo][Tt]\b[{BLANK}]?)"
HIDDEN = re.compile(rf"(?:@|\b[Aa][Tt]\b)[{BLANK}]?[\])}}>]?[{BLANK}]?{LABEL}(?:{STOP}{LABEL}){{1,5}}")
BEFORE = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}[{BLANK}]?[\[({{<]?[{BLANK}]?\Z")
LONGEST = 24
ENDINGS = frozenset("com org net edu gov info io de fr es it uk eu nl pl pt se ch at us ca".split())
PLACES = frozenset("available look us hosted found site page online shop visit see read download listed sold stay live".split())


def sign(token: str) -> str:
    """What a separator counts as: a line break, a blank, a dash or itself."""
    if token.isspace():
        return "\n" if "\n" in token or "\r" in token else " "
    return "-" if "\u2010" <= token <= "\u2015" or token == "\u2212" else token


def candidates(tokens: list[str]) -> Iterator[tuple[int, int, str, dict[str, float]]]:
    """(first, end, kind, features) of segments of at most LONGEST tokens that could be of a kind at all."""
    digit = [t[0].isdigit() and t.isascii() for t in tokens]
    word = [t.isalpha() and t.isascii() for t in tokens]
    for i, t in enumerate(tokens):
        if not (digit[i] or word[i] or t in "+(["):
            continue
        number, at_seen, dots = "", False, 0
        for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
            last = tokens[j - 1]
            if digit[j - 1]:
                number += last
            elif word[j - 1]:
                at_seen |= last.lower() == "at"
                dots += at_seen and last.lower() == "dot"
            else:
                at_seen |= last == "@"
                dots += at_seen and last == "."
            if not (digit[j - 1] or word[j - 1]) or len(number) > 19:
                continue
            inside = tokens[i:j]
            if dots and t.lower() not in ("at", "dot") and word[j - 1] and last.lower() not in ("at", "dot"):
                yield i, j, "email", features("email", inside, tokens, i, j)
            if not any(word[i:j]):
                n = len(number)
                if 13 <= n <= 19 and digit[i]:
                    yield i, j, "card", features("card", inside, tokens, i, j)
                if 9 <= n <= 15:
                    yield i, j, "phone", features("phone", inside, tokens, i, j)
                if sum(digit[i:j]) == 4 and digit[i]:
                    yield i, j, "ip", features("ip", inside, tokens, i, j)


def features(kind: str, inside: list[str], tokens: list[str], i: int, j: int) -> dict[str, float]:
    """Whole-span features: checks, grouping of digits, separators, and what stands around the span."""
    groups = [t for t in inside if t[0].isdigit()]
    number = "".join(groups)
    signs = sorted({sign(t) for t in inside if not t[0].isalnum()})
    out = {"bias": 1.0, "groups " + "-".join(str(len(g)) for g in groups[:6]): 1.0, "signs " + "".join(signs): 1.0, f"digits {len(number)}": 1.0, f"opens {inside[0] if not inside[0].isalnum() else 'x'}": 1.0}
    if kind == "card":
        out["luhn" if luhn(number) else "no luhn"] = 1.0
    if kind == "ip":
        out["octets" if all(len(g) < 4 and int(g) <= 255 for g in groups) and len(groups) == 4 else "no octets"] = 1.0
    if kind == "email":
        out["known ending" if inside[-1].lower() in ENDINGS else "other ending"] = 1.0
        out["brackets" if {"(", "[", "{"} & set(signs) else "bare"] = 1.0
        out["local digits" if number else "local letters"] = 1.0
        low = [t.lower() for t in inside]
        out[f"{'@' if '@' in low else 'at'} {'dot' if 'dot' in low else '.'} {'known' if low[-1] in ENDINGS else 'other'}"] = 1.0
        local = "".join(low[: min(low.index(t) for t in ("at", "@") if t in low)]).rstrip(" \t\xa0\u2007\u2009\u202f[({<")
        if any(c.isspace() for c in local):
            out["several words"] = 1.0
        if low[0] in PLACES:
            out["place"] = 1.0
    if inside.count("(") != inside.count(")"):
        out["unbalanced"] = 1.0
    for name, k in (("before", i - 1), ("after", j)):
        t = tokens[k] if 0 <= k < len(tokens) else "edge"
        out[f"{name} {'space' if t.isspace() else 'digit' if t[0].isdigit() else 'word' if t.isalpha() else t}"] = 1.0
    return {f"{kind} {k}": v for k, v in out.items()}


class SemiCrf:
    """Segments of one outside token or a typed span of up to LONGEST tokens; span weights are log-linear, outside tokens weigh 0.

    Best segmentation and likelihood gradient are by dynamic programming over token ends; only spans that could be of a kind
    are scored, so the cost is linear in the tokens.
    """

    def __init__(self) -> None:
        self.weights: dict[str, float] = defaultdict(float)

    def segments(self, tokens: list[str]) -> list[tuple[int, int, str, dict[str, float], float]]:
        return [(i, j, k, f, sum(self.weights.get(n, 0.0) * v for n, v in f.items())) for i, j, k, f in candidates(tokens)]

    def best(self, tokens: list[str], margin: float = 0.0) -> list[tuple[int, int, str]]:
        ends = defaultdict(list)
        for i, j, kind, _, s in self.segments(tokens):
            ends[j].append((i, kind, s - margin))
        value, back = [0.0] * (len(tokens) + 1), [(0, "")] * (len(tokens) + 1)
        for j in range(1, len(tokens) + 1):
            value[j], back[j] = value[j - 1], (j - 1, "")
            for i, kind, s in ends[j]:
                if value[i] + s > value[j]:
                    value[j], back[j] = value[i] + s, (i, kind)
        out, j = [], len(tokens)
        while j:
            i, kind = back[j]
            if kind:
                out.append((i, j, kind))
            j = i
        return out[::-1]

    def fit(self, examples: list[tuple[list[str], set[tuple[int, int, str]]]], epochs: int = 12, rate: float = 0.3, decay: float = 0.0003) -> None:
        for epoch in range(epochs):
            step = rate / (1 + 0.3 * epoch)
            for tokens, gold in examples:
                found = self.segments(tokens)
                n = len(tokens)
                ends, starts = defaultdict(list), defaultdict(list)
                for i, j, *_, s in found:
                    ends[j].append((i, s))
                    starts[i].append((j, s))
                ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
                for j in range(1, n + 1):
                    ahead[j] = float(np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + s for i, s in ends[j])]))
                for i in range(n - 1, -1, -1):
                    behind[i] = float(np.logaddexp.reduce([behind[i + 1], *(behind[j] + s for j, s in starts[i])]))
                for i, j, kind, f, s in found:
                    gap = ((i, j, kind) in gold) - float(np.exp(ahead[i] + s + behind[j] - ahead[n]))
                    if abs(gap) > 1e-4:
                        for name, v in f.items():
                            self.weights[name] += step * (gap * v - decay * self.weights[name])
        self.weights = dict(self.weights)


def examples(seed: int = 11, count: int = 400, more: int = 400) -> list[tuple[list[str], set[tuple[int, int, str]]]]:
    """Seeded training windows: numbers, phones, cards, addresses and disguised e-mail of many forms between words, and look-alikes; more of rarer signs."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    w = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 8)))

    def card() -> str:
        body = r.choice("3456") + d(14)
        return body + next(c for c in "0123456789" if luhn(body + c))

    def one() -> tuple[str, str]:
        kind = r.randrange(16)
        if kind < 2:
            return r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"+{d(1)} {d(3)} {d(3)} {d(4)}"]), "phone"
        if kind < 4:
            c = card()
            s = r.choice(["", " ", "-", "."])
            return s.join((c[:4], c[4:8], c[8:12], c[12:])), "card"
        if kind < 5:
            return ".".join(str(r.randint(0, 255)) for _ in range(4)), "ip"
        if kind < 9:
            a, b = r.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] ")])
            return f"{w()}{r.choice(['', '.' + w(), d(2)])}{a}{w()}{b}{r.choice(['com', 'org', 'net', 'de'])}", "email"
        if kind < 11:
            c = card()
            return c[:-1] + str((int(c[-1]) + 1 + r.randrange(8)) % 10), ""
        return r.choice([f"{r.randint(1900, 2030)}-{d(2)}-{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", d(r.randint(5, 12)), f"{d(3)} {d(3)}", f"{d(2)}/{d(2)}/{r.randint(1990, 2030)}", f"{d(4)} - {d(4)} - {d(2)}", f"{w()} at {w()} dot {w()}", f"{w()} at {w()} {w()}", f"{r.randint(256, 999)}.{d(2)}.{d(3)}.{d(1)}", f"{d(9)}.{d(2)}", f"{d(2)} {d(2)} {d(2)} {d(2)} {d(2)}"]), ""

    def other() -> tuple[str, str]:
        kind = r.randrange(16)
        gap = r.choice("\xa0\u202f\u2009\u2010\u2011\u2013\u2014\u2212\t")
        if kind < 3:
            return r.choice([f"{d(3)}{gap}{d(3)}{gap}{d(4)}", f"({d(3)}){gap}{d(3)}-{d(4)}", f"[{d(3)}] {d(3)}-{d(4)}", f"+{d(1)}{gap}{d(3)}{gap}{d(3)}{gap}{d(4)}", f"({d(3)}) {d(3)}-\n{d(4)}", f"{d(3)}\n{d(3)}-{d(4)}"]), "phone"
        if kind < 5:
            c = card()
            return gap.join((c[:4], c[4:8], c[8:12], c[12:])), "card"
        if kind < 6:
            return r.choice(["[.]", "(.)"]).join(str(r.randint(0, 255)) for _ in range(4)), "ip"
        if kind < 11:
            a, b = r.choice([" at ", " at ", " at ", "[at]", " (at) ", " [at] ", "(at)", "@", " @ ", "[@]"]), r.choice([".", ".", ".", "[.]", "(.)", " dot ", "[dot]", " (dot) "])
            a = " @ " if a == "@" and b == "." else a
            return f"{w()}{r.choice(['', '.' + w(), d(2)])}{a}{w()}{r.choice(['', b + w()])}{b}{r.choice(['com', 'org', 'net', 'de'])}", "email"
        if kind < 12:
            return f"{r.choice(sorted(PLACES))} at {r.choice(['', w() + '.'])}{w()}.{r.choice(['com', 'org', 'net', 'de'])}", ""
        if kind < 13:
            c = card()
            c = c[:-1] + str((int(c[-1]) + 1 + r.randrange(8)) % 10)
            return gap.join((c[:4], c[4:8], c[8:12], c[12:])), ""
        return r.choice([f"{w()} at {w()}.{w()}", f"{w()} @ {w()}.{w()}", f"{r.randint(1900, 2030)}\u2013{r.randint(1900, 2030)}", "\n".join(d(r.randint(2, 4)) for _ in range(r.randint(3, 5))), "\t".join(d(r.randint(1, 5)) for _ in range(r.randint(3, 5))), f"{d(3)}{gap}{d(3)}", f"[{d(2)}] [{d(2)}] [{d(2)}]", f"{d(5)}\n{d(5)}"]), ""

    out = []
    for k in range(count + more):
        tokens: list[str] = []
        gold = set()
        for _ in range(r.randint(1, 2)):
            tokens += [w(), " "]
            text, kind = one() if k < count else other()
            own = TOKEN.findall(text)
            if kind:
                gold.add((len(tokens), len(tokens) + len(own), kind))
            tokens += [*own, r.choice([" ", ", ", ". "])[0], " "]
        out.append(([*tokens, w()], gold))
    r.shuffle(out)
    return out


def trained() -> SemiCrf:
    model = SemiCrf()
    model.fit(examples())
    return model


def added_spans(text: str, base: list[Span], model: SemiCrf, margin: float = 1.0) -> list[Span]:
    """Spans the model finds in windows of numbers or disguised e-mail, outside all base spans, each at least margin above leaving it out."""
    taken = sorted((s, e) for _, s, e in base)
    windows = [m.span() for m in NUMBERS.finditer(text) if m.end() - m.start() >= 7 and len(digits_of(m.group())) >= 4]
    for m in HIDDEN.finditer(text):
        if local := BEFORE.search(text, max(0, m.start() - 67), m.start()):
            windows.append((local.start(), m.end()))
    out = []
    for start, end in sorted(windows):
        free, at = [], start
        for s, e in taken:
            if e > at and s < end:
                free.append((at, s))
                at = max(at, e)
        for s, e in [*free, (at, end)]:
            if e - s < 7:
                continue
            lead, tail = text[max(0, s - 1) : s], text[e : e + 1]
            tokens = [*([lead] if lead else []), *TOKEN.findall(text, s, e), *([tail] if tail else [])]
            places = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))) + s - len(lead)
            for i, j, kind in model.best(tokens, margin):
                if places[i] >= s and places[j] <= e and not any(places[i] < y and x < places[j] for _, x, y in out):
                    out.append((kind, int(places[i]), int(places[j])))
    return out


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def masked(text: str, spans: list[Span]) -> str:
    """Every span replaced by its kind in brackets; of overlapping spans the union, by the kind that begins first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_pii(spark: SparkSession, docs: DataFrame, text: str = "text", mask: bool = False) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all); columns of these names are replaced.

    With mask, the text has its spans replaced by [EMAIL] and so on. The model is fitted on seeded examples (their number is
    a documented parameter) on the driver and travels with the function. No shuffle; each whole text is read once.
    Null or empty text has no spans; a null text stays null.
    """
    own = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rest = [c for c in docs.columns if c not in own]
    rows = docs.select(F.col(text).alias("__text"), *[F.lit(None).cast("string").alias(c) if mask and c == text else c for c in rest])
    schema = docs.select(*rest).schema
    for name in own:
        schema = schema.add(name, "long" if name[:2] == "n_" else "string")
    model = trained()
    nothing = hashlib.sha256(b"").hexdigest()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in own}
            texts = []
            for cell in batch.column(0):
                body = cell.as_py()
                base = base_spans(body) if body and SOME.search(body) else []
                spans = base + added_spans(body, base, model) if body and SOME.search(body) else []
                for kind in KINDS:
                    columns[f"n_{kind}"].append(sum(k == kind for k, *_ in base))
                columns["base_sha256"].append(hashlib.sha256(spelled(base).encode()).hexdigest() if base else nothing)
                columns["spans"].append(spelled(spans))
                if mask:
                    texts.append(masked(body, spans) if spans else body)
            kept = {c: pa.array(texts, pa.string()) if mask and c == text else batch.column(k + 1) for k, c in enumerate(rest)}
            yield pa.record_batch(kept | {c: pa.array(v, pa.int64() if c[:2] == "n_" else pa.string()) for c, v in columns.items()})

    return rows.mapInArrow(lambda b: released(found(b)), schema)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spark, table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
