"""Personal data: fixed patterns, and a character tagger for what they miss.

The tagger is a bidirectional LSTM with CRF transitions, trained in numpy on windows around spans that the patterns have
labelled, some of them rewritten the way people write around filters. A text is read in overlapping windows; each
character takes its tag from the window it stands most central in, and spans are put together over the whole text.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.bilstm import PADDING, Tagger, char_ids
from tollbook.llm.common import sample, stored

KINDS = ["email", "ip", "card", "phone"]
# The base patterns. A look-behind keeps them from trying again inside a run they have refused.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Cells that hold one of these are read: digits, "@", bracketed "at", the word "dot", and "at" before a label and a dot. The
#: words may stand between any signs, or in capitals between small letters.
_AT, _DOT = (rf"(?:(?<![A-Za-z0-9])(?i:{w})(?![A-Za-z0-9])|(?<=[a-z0-9]){w.upper()}(?=[a-z0-9]))" for w in ("at", "dot"))
TRIGGER = re.compile(rf"[0-9@]|[(\[{{<] ?(?i:at) ?[)\]}}>]|{_DOT}|{_AT}(?=[^A-Za-z0-9]{{0,4}}[\w-]{{1,63}}[^A-Za-z0-9.]{{0,4}}\.\s?[^\W_])")
#: "at" and "dot" as people write them.
WRITTEN = [
    ("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("(at)", "."), (" [at] ", "."), (" at ", " dot "), ("{at}", "{dot}"),
    (" <at> ", "."), (" AT ", " DOT "), ("_at_", "_dot_"), (" at ", "."), ("AT", "DOT"), (" {at} ", " {dot} "), ("<at>", "<dot>"),
]
ENDINGS = ["com", "org", "net", "de", "fr", "es", "io", "info", "co.uk", "eu"]
WINDOW, STEP = 96, 48
#: Bounds of the training sample: windows around spans, and windows around decoys and other triggers.
SPANS, OTHERS, STEPS = 3000, 3000, 450
#: Ways in which each span is written for training, the first one as it is.
VARIANTS = 8


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def find_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards, so long runs without one cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def find_base(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base spans, in this order."""
    out = [(a, 0, b) for a, b in find_emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p) < 4 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def made_up(draw: int) -> str:
    """A word of two or three syllables, so that names and hosts are not only those of the documents."""
    out = ""
    for _ in range(2 + draw % 2):
        out += "bcdfghklmnprstvwz"[draw % 17] + "aeiou"[draw // 17 % 5] + ["", "", "n", "r", "l", "s"][draw // 85 % 6]
        draw = draw * 48271 % 2147483647
    return out


def rewrite(span: str, kind: int, draw: int, words: list[str] | None = None) -> str:
    """A span the way it is written to get past filters; ``draw`` chooses. Of ``words``, if given, names and hosts are made."""
    if kind == 0:
        if words and draw // 97 % 3:
            one, two, host = (words[draw // n % len(words)].lower() if draw // n % 3 else made_up(draw // n + n) for n in (5, 29, 211))
            name = [one, f"{one}.{two}", f"{one}_{two[:3]}", f"{one[0]}.{two}", f"{one}{draw % 90 + 10}", f"{one}-{two}"][draw // 7 % 6]
            span = f"{name}@{['', 'mail.', f'host{draw % 10}.', f'{two}-'][draw // 11 % 4]}{host}.{ENDINGS[draw // 13 % len(ENDINGS)]}"
        at, dot = WRITTEN[draw % len(WRITTEN)]
        name, _, host = span.partition("@")
        return name + at + host.replace(".", dot)
    if kind == 1:
        return span.replace(".", ["." , " . ", "[.]", "(.)", "[.]", " [.] "][draw % 6])
    if kind == 2:
        digits = _digits(span)
        gap = ["", "", ".", "/", "_", " / "][draw % 6]
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4)) if gap else span
    # Other digits than the given ones, which may all be of one exchange.
    digits = f"{zlib.crc32(span.encode()) * draw % 10**10:010}"
    area, rest = digits[:3], digits[3:]
    forms = [
        span, re.sub(r"^\+[0-9]+[ .-]?", "", span), "00" + span[1:], f"0{area} {rest}", f"0{area}/{rest}", f"({area}) {rest[:3]}-{rest[3:]}",
        f"{area}-{rest[:3]}-{rest[3:]}", f"00{draw % 80 + 20} {area} {rest[:6]}", f"0{area} {rest[:3]} {rest[3:]}", f"{area}.{rest[:3]}.{rest[3:]}",
    ]
    return forms[draw % len(forms)]


def decoy(draw: int, word: str) -> str:
    """What looks like personal data in part and is none: dates, versions, sums, times, and "at" and "dot" in prose."""
    a, b, c = draw % 97, draw // 97 % 89, draw // 8633 % 83
    forms = [
        f"{a % 28 + 1:02}.{b % 12 + 1:02}.{1940 + c}", f"{a % 28 + 1}.{b % 12 + 1}.{c}", f"{1940 + c}-{b % 12 + 1:02}-{a % 28 + 1:02}", f"version {a % 9}.{b}.{c % 9}",
        f"{a % 24}:{b % 60:02}", f"{a},{b * 11 % 1000:03},{c * 12 % 1000:03}", f"{a}.{c}", f"no {a}{b}{c}{a}", f"at {word}", f"{word} at the dot", "dot dot", f"at {a % 12 + 1} pm",
        f"at {word}.{ENDINGS[b % len(ENDINGS)]}", f"section {a}.{b}.{c}", f"{a}/{b}/{1940 + c}", f"({a}) {word}", f"id {a}{b}{c}", f"look at {word} dot {word}", f"AT {word.upper()}", f"{a}-{b}-{c}",
    ]
    return forms[draw // 7 % len(forms)]


def examples(text: str, draw: int, variants: int = VARIANTS) -> list[tuple[str, str, bool]]:
    """Windows with a letter per character that names its tag, and whether a span is meant. Each is cut from the text.

    Every span that overlaps no other is written in ``variants`` ways. Windows without one show a trigger of every cell that
    holds any, and as many decoys as there are spans, two at least.
    """
    out, spans = [], find_base(text)
    words = re.findall("[A-Za-z]{2,12}", text[:4000]) or ["word"]
    for n, (start, kind, end) in enumerate(spans):
        if any(start < b and a < end for a, _, b in spans[max(0, n - 20) : n] + spans[n + 1 : n + 21]):
            continue
        for variant in range(variants):
            seed = zlib.crc32(f"{draw}:{start}:{variant}".encode())
            written = text[start:end] if variant == 0 else rewrite(text[start:end], kind, seed, words)
            if kind != 3 and variant and find_base(written) and written == text[start:end]:
                continue
            # Of every other way the word before it goes, so that what people write in front is no condition.
            stop = start if variant % 2 == 0 else text.rfind(" ", 0, max(0, start - 1)) + 1
            begin = max(0, stop - seed // 7 % max(1, WINDOW - len(written)))
            before, after = text[begin:stop], text[end : end + WINDOW]
            marks = [(a, k, b) for a, k, b in spans if b <= start or a >= end]
            tags = _tags(begin, stop, marks) + _mark(len(written), kind) + _tags(end, end + len(after), marks)
            out.append(((before + written + after)[:WINDOW], tags[:WINDOW], True))
    cells = {m.start() // STEP: m for m in TRIGGER.finditer(text)}
    for m in cells.values():
        if not any(a - 8 < m.start() < b + 8 for a, _, b in spans):
            begin = max(0, m.start() - zlib.crc32(f"{draw}:{m.start()}".encode()) % WINDOW)
            part = text[begin : begin + WINDOW]
            out.append((part, _tags(begin, begin + len(part), spans), False))
    for n in range(max(2, len(spans))):
        seed = zlib.crc32(f"{draw}:decoy:{n}".encode())
        at = seed % (len(text) + 1)
        at = text.rfind(" ", 0, at) + 1
        left = seed // 11 % (WINDOW // 2)
        put = decoy(seed, words[seed // 5 % len(words)].lower()) + " "
        before, after = text[max(0, at - left) : at], text[at : at + WINDOW]
        tags = _tags(max(0, at - left), at, spans) + "a" * len(put) + _tags(at, at + len(after), spans)
        out.append(((before + put + after)[:WINDOW], tags[:WINDOW], False))
    return out


def _mark(size: int, kind: int) -> str:
    return chr(ord("a") + 1 + 2 * kind) + chr(ord("a") + 2 + 2 * kind) * (size - 1) if size else ""


def _tags(begin: int, end: int, spans) -> str:
    tags = ["a"] * (end - begin)
    for a, kind, b in spans:
        for i in range(max(a, begin), min(b, end)):
            tags[i - begin] = chr(ord("a") + (1 if i == a else 2) + 2 * kind)
    return "".join(tags)


def train(documents: DataFrame, spans: int = SPANS, others: int = OTHERS, steps: int = STEPS) -> Tagger | None:
    """Learn from windows of texts with a digit, an ``@`` or the words "at" or "dot": at most ``spans`` with a span and
    ``others`` without, by hash."""

    def cut(batches):
        for frame in batches:
            rows = [e for t in frame["text"] for e in examples(t, zlib.crc32(t.encode()))]
            yield pd.DataFrame(rows, columns=["part", "tags", "span"])

    texts = documents.select("text").where(F.regexp_like("text", F.lit(r"[0-9@]|(?i:\b(?:at|dot)\b)")))
    found = stored(texts.mapInPandas(cut, "part string, tags string, span boolean").distinct(), "pii-windows")
    chosen = [sample(found.where(test), most, "part", "tags") for test, most in (("span", spans), ("not span", others))]
    windows = pd.concat([c.select("part", "tags").toPandas() for c in chosen])
    if not len(windows):
        return None
    ids = np.full((len(windows), WINDOW), PADDING)
    tags = np.zeros((len(windows), WINDOW), np.int64)
    for i, (part, marks) in enumerate(zip(windows["part"], windows["tags"])):
        ids[i, : len(part)] = char_ids(part)
        tags[i, : len(part)] = [ord(t) - ord("a") for t in marks]
    return Tagger(KINDS).fit(ids, tags, steps, rate=0.02)


def cells_of(text: str) -> list[int]:
    """Cells of a step's length in which a trigger begins, or the cell beside it holds one: those that are read first."""
    near = {m.start() // STEP for m in TRIGGER.finditer(text)}
    return sorted({c for n in near for c in (n - 1, n, n + 1) if 0 <= c <= (len(text) - 1) // STEP})


def tag_cells(tagger: Tagger, cells: list[tuple[str, int]], batch: int = 1024) -> list[np.ndarray]:
    """Tags of cells ``(text, cell)``: the window around each is decoded, and its central part is kept."""
    out = []
    for at in range(0, len(cells), batch):
        some = cells[at : at + batch]
        ids = np.full((len(some), WINDOW), PADDING)
        for i, (text, cell) in enumerate(some):
            begin = cell * STEP - (WINDOW - STEP) // 2
            part = char_ids(text[max(0, begin) : begin + WINDOW])
            ids[i, max(0, -begin) : max(0, -begin) + len(part)] = part
        tags = tagger.decode(ids)[:, (WINDOW - STEP) // 2 : (WINDOW + STEP) // 2]
        out += list(tags)
    return out


def spans_of(tags: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of tags at the rising places ``at``: a span goes on, over seams too, while the kind stays and places follow."""
    out = []
    for place, tag in zip(at.tolist(), tags.tolist()):
        kind = (tag - 1) // 2
        if tag and out and out[-1][2] == place and out[-1][1] == kind and tag % 2 == 0:
            out[-1] = (out[-1][0], kind, place + 1)
        elif tag:
            out.append((place, kind, place + 1))
    return out


#: Written-out addresses: a name, "at" or its sign, and labels divided by dots or the word, with few other signs between.
_GAP = r"(?:[\s\W_]{0,3})"
ADDRESS = re.compile(rf"(?i)[a-z0-9](?:[a-z0-9.%+_-]|{_GAP}dot{_GAP}(?=[a-z0-9]))*?{_GAP}(?:@|at){_GAP}[a-z0-9][a-z0-9-]*(?:{_GAP}(?:\.|dot){_GAP}[a-z0-9-]+)+")


def plausible(span: str, kind: int) -> bool:
    """Whether an added span holds what its kind must."""
    digits = _digits(span)
    if kind == 0:
        return len(span) >= 8 and ADDRESS.fullmatch(span) is not None
    if kind == 1:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and re.fullmatch(r"[+(]?[0-9(][0-9()\s./-]*[0-9]", span) is not None


def whole_words(text: str, start: int, end: int) -> tuple[int, int]:
    """A span widened to the ends of the words that it cuts, and without blanks at its ends."""
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    while start > 0 and text[start - 1].isalnum() and text[start].isalnum():
        start -= 1
    while end < len(text) and text[end].isalnum() and text[end - 1].isalnum():
        end += 1
    return start, end


def added_spans(tagger: Tagger, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger finds beside the base spans of each text.

    Where a tag stands at the edge of what is read, the next cell is read too, so no span is cut there.
    """
    read: list[dict[int, np.ndarray]] = [{} for _ in texts]
    cells = [(n, c) for n, text in enumerate(texts) for c in cells_of(text)]
    while cells:
        for (n, c), tags in zip(cells, tag_cells(tagger, [(texts[n], c) for n, c in cells])):
            read[n][c] = tags[: len(texts[n]) - c * STEP]
        edges = {(n, c + way) for n, c in cells for way, at in ((-1, 0), (1, -1)) if read[n][c][at]}
        cells = sorted((n, c) for n, c in edges if 0 <= c * STEP < len(texts[n]) and c not in read[n])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for n, mine in enumerate(read):
        text, taken, order = texts[n], base[n], sorted(mine)
        if not order:
            continue
        places = np.concatenate([c * STEP + np.arange(len(mine[c])) for c in order])
        for start, kind, end in spans_of(np.concatenate([mine[c] for c in order]), places):
            start, end = whole_words(text, start, end)
            address = ADDRESS.search(text, start, end) if kind == 0 else None
            if address:  # words before or after it go
                start, end = address.span()
            if plausible(text[start:end], kind) and not any(start < b and a < end for a, _, b in [*taken, *out[n][-1:]]):
                out[n].append((start, kind, end))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def find_personal_data(documents: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``doc_id, base, spans`` of every row of ``documents(doc_id, text)``, each as ``kind:start:end`` joined by commas.

    ``base`` are the spans of the patterns; ``spans`` holds them and those that the tagger adds where they overlap none.
    Places are code points, the end is exclusive; spans go by start and then kind. Null text counts as empty; null ids
    and repeated rows all return. Without a tagger, one is trained on these documents. Texts are read whole; a text
    without a digit, ``@``, "at" or "dot" as in TRIGGER is only searched for these. Other columns are ignored; no rows give no rows.
    """
    tagger = tagger or train(documents)

    @F.pandas_udf("base string, spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        texts = texts.tolist()
        base = [find_base(t) for t in texts]
        more = added_spans(tagger, texts, base) if tagger else [[] for _ in texts]
        return pd.DataFrame({"base": [joined(b) for b in base], "spans": [joined(b + m) for b, m in zip(base, more)]})

    rows = documents.select("doc_id", find(F.coalesce("text", F.lit(""))).alias("found"))
    return rows.select("doc_id", "found.base", "found.spans")
