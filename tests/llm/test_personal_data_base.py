"""Base spans of the personal data scan, all four kinds, against plain patterns."""

import hashlib
import re

from pyspark.sql import functions as F

from fieldbook.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(number):
    total = 0
    for k, d in enumerate(reversed(number)):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group())):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def compare(docs):
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    seen = [0] * 4
    for r in rows:
        spans = plain(r.text or "")
        n = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        seen = [a + b for a, b in zip(seen, n, strict=True)]
        line = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)
        mine = got[r.doc_id]
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == n, r.doc_id
        assert mine.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), r.doc_id
        assert set(filter(None, line.split(","))) <= set(mine.spans.split(","))
    return seen


def test_base_spans_of_the_given_documents(spark):
    seen = compare(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert all(seen[k] for k in (0, 1))


def test_base_spans_of_hard_cases(spark):
    texts = ["4111 1111 1111 1111 and 4111-1111-1111-1112", "card 378282246310005, 6011000990139424; 30569309025904", "0000 0000 0000",
             "4111 1111 1111 11114111 1111 1111 1111 4111", "+49 (30) 901820-0 or +1.202.555.0143x", "+123 +12345678 +1234567890123456",
             "+4 9 1 1 1 1 1 1 1", "1.2.3.4 1.2.3.4.5 256.1.1.1 0001.2.3.4 1..2.3.4", "a@b a@b.c a.b+c@d-e.f.g, @x.y x@.y x@y..z x@y.z.",
             "٤١١١ ١١١١", "é+33 1 23 45 67 89é", "4111\t1111\t1111\t1111", "1 " * 40, "", None, "x" * 20_000 + " q@w.er"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for name in ("kind", "span", "pattern", "n_email", "spans"):
        docs = docs.withColumn(name, F.lit(name))
    assert all(compare(docs))
