"""Held-out quality of the tagger on written-out data and on what only looks like it, and the registered form."""

import hashlib
import random
import re
import zlib

from llm_cases import AWKWARD, documents
from pyspark.sql import functions as F
from test_llm_models import plain_personal

from tollbook.llm import pii, queries


class Cases:
    """Spans written in ways that the patterns don't know, and decoys, in the prose of held-out documents."""

    def __init__(self, texts):
        self.draw, self.texts = random.Random(5), texts

    def digits(self, n):
        return "".join(str(self.draw.randrange(10)) for _ in range(n))

    def prose(self, n=12):
        words = self.draw.choice(self.texts).split()
        at = self.draw.randrange(max(1, len(words) - n))
        return " ".join(w for w in words[at : at + n] if not re.search("[0-9@]", w))

    def host(self):
        pick = self.draw.choice
        return pick(["example", "mail7.example", "host3.example", "uni-koeln", "web"]) + "." + pick(["com", "org", "net", "de"])

    def email(self):
        name = self.draw.choice(["anna", "koch", "peter.lang", "m_weber", "lisa42", "sales", "j.doe", "info", "maria", "tom"])
        at, dot = self.draw.choice(pii.WRITTEN[1:])
        return name + at + self.host().replace(".", dot)

    def ip(self):
        return self.draw.choice(["[.]", " . ", "(.)"]).join(str(self.draw.randrange(1, 256)) for _ in range(4))

    def card(self):
        body = "4" + self.digits(14)
        whole = body + next(c for c in "0123456789" if pii.luhn(body + c))
        return self.draw.choice("/._").join(whole[i : i + 4] for i in range(0, 16, 4))

    def phone(self):
        d = self.digits
        return self.draw.choice([f"0{d(3)} {d(7)}", f"({d(3)}) 555-{d(4)}", f"00{d(2)} {d(3)} {d(6)}", f"0{d(3)}/{d(7)}"])

    def decoy(self):
        r, d = self.draw.randrange, self.digits
        return self.draw.choice([
            f"{r(1, 29):02}.{r(1, 13):02}.{r(1950, 2024)}", f"version {r(9)}.{r(20)}.{r(9)}", "at home", "look at the dot on it", f"{r(9)},{d(3)},{d(3)}",
            f"id {d(6)}", f"{r(24)}:{d(2)}", f"order no {d(8)}", f"section {r(9)}.{r(9)}.{r(9)}", f"{d(4)}-{r(1, 12):02}-{r(1, 28):02}", f"at {r(12)} pm",
        ])


def test_the_tagger_finds_what_the_patterns_miss_in_held_out_documents(spark):
    docs = queries.read_table(spark, "/root/testdata/sf0.01", "documents").where("text is not null")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tagger = pii.train(docs.where(~held))
    cases = Cases([r["text"] for r in docs.where(held).select("text").collect() if r["text"]])
    made = []
    for kind in pii.KINDS * 100:
        span, before = getattr(cases, kind)(), cases.prose() + " "
        made.append((before + span + " " + cases.prose(), kind, len(before), len(before) + len(span)))
    texts = [m[0] for m in made]
    found = pii.added_spans(tagger, texts, [pii.find_base(t) for t in texts])
    hits = {kind: 0 for kind in pii.KINDS}
    wrong = 0
    for (_, kind, start, end), spans in zip(made, found):
        hits[kind] += (start, pii.KINDS.index(kind), end) in spans
        wrong += sum(s != (start, pii.KINDS.index(kind), end) for s in spans)
    others = [f"{cases.prose()} {cases.decoy()} {cases.prose()}" for _ in range(400)]
    false = sum(map(len, pii.added_spans(tagger, others, [pii.find_base(t) for t in others])))
    recall, precision = sum(hits.values()) / len(made), sum(hits.values()) / (sum(hits.values()) + wrong + false)
    assert recall >= 0.8 and precision >= 0.8, (hits, wrong, false)


def test_shapes_of_added_spans():
    good = [("anna.koch at mail7.example dot com", 0), ("anna{at}example{dot}com", 0), ("tom [at] web [dot] de", 0), ("192[.]168[.]0[.]1", 1), ("10 . 0 . 0 . 1", 1), ("4111/1111/1111/1111", 2), ("0151 2345678", 3)]
    bad = [("at example.com", 0), ("look at home", 0), ("12.03.1987", 1), ("1.2.3", 1), ("300.1.1.1", 1), ("4111/1111/1111/1112", 2), ("12345678", 3), ("id 123456789", 3)]
    assert all(pii.plausible(s, k) for s, k in good) and not any(pii.plausible(s, k) for s, k in bad)
    assert pii.whole_words("ab cdef gh", 5, 7) == (3, 7) and pii.whole_words("ab cdef gh", 2, 5) == (3, 7)


def test_every_window_matches_its_tags_and_their_number_is_bounded():
    text = "so it was a.b@c.de and 10.0.0.1 or 7 8 9 " + "12 " * 3000
    found = pii.examples(text, 5)
    assert all(len(p) == len(t) <= pii.WINDOW for p, t, _ in found) and {s for *_, s in found} == {True, False}
    assert len(found) <= 2 * pii.VARIANTS + len(text) // pii.STEP + 5
    for part, tags, _ in pii.examples(text[:45], 5, variants=1):
        for m in re.finditer("[bd][ce]*", tags):
            assert plain_personal(part) == [] or (m.start(), m.end()) in {(a, b) for a, _, b in plain_personal(part)} or m.end() == len(tags)


def test_registered_counts_and_digests(spark, tmp_path):
    made = [(100, "a.b@c.de 10.0.0.1 é +1 (743) 555-3824", "en", "a"), (101, "card 4111 1111 1111 1111, 10.0.0.1.5", "en", "a")]
    rows = [r for r in AWKWARD if r[0] != 4] + made
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r)[:6] for r in queries.op4(spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        base = plain_personal(text or "")
        kinds = [sum(k == n for _, k, _ in base) for n in range(4)]
        shown = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        want.append((doc_id, *kinds, hashlib.sha256(shown.encode()).hexdigest()))
    assert got == sorted(want, key=str)
