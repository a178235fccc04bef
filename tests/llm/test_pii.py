"""Base spans next to plain regular expressions, and the weakly supervised spans."""

import hashlib
import re

import pytest

from pulsegrid.llm import pii
from pulsegrid.llm.queries import QUERIES


def plain_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            n = int(c) * (2 if i % 2 else 1)
            total += n - 9 if n > 9 else n
        return total % 10 == 0
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_random(rng):
    letters = list("aB0123456789.@-+ ()_%é\n") + ["4111 1111 1111 1111", "a@b.c", "10.0.0.255", "+1 (555) 010-9999", "256.1.1.1", "@@", ".."]
    for _ in range(6000):
        text = "".join(rng.choice(letters, rng.integers(0, 25)))
        assert pii.base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "a@" * 100_000, "1 " * 150_000 + "x", "1." * 150_000, "+" * 300_000,
                                  "9" * 200_000 + ".1.1.1", "at dot " * 60_000, "A" * 300_000 + "1", "Mr " * 100_000, "(" * 300_000])
def test_long_texts_take_linear_time(text):
    base = pii.base_spans(text)
    pii.candidates(text, base)


DOCS = "doc_id long, text string, spans string"
SECRETS = [f"please use password={h} now" for h in ("a81bc81b9e0f4d3a7711", "0f9e8d7c6b5a43210abc", "77aa88bb99cc00dd11ee")] * 20
PLAIN = ["see commit 0123456789ab012345 here", "build 77777777777712 of page 12345678901", "in 2020-01-02 we", "path /usr/lib/python3abc99x2 is"] * 20


def corpus(spark):
    rows = [(i, t, "x") for i, t in enumerate(SECRETS + PLAIN)]
    rows += [(1000, None, None), (1001, "", None), (None, "mail a.b@c.org or +49 30 1234567", None), (1002, "É a.b@c.org", None), (1002, "É a.b@c.org", None)]
    return spark.createDataFrame(rows, DOCS)


def test_weak_supervision(spark):
    docs = corpus(spark)
    model = pii.learn(docs)
    got = {}
    for r in pii.find(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(SECRETS):
        a = text.index("=") + 1
        assert got[i][0].spans == f"secret:{a}:{a + 20}"
    assert all(got[len(SECRETS) + i][0].spans == "" for i in range(len(PLAIN)))
    assert got[1000][0].spans == got[1001][0].spans == "" and len(got[1002]) == 2
    assert got[1002][0].base == "email:2:11" and got[None][0].n_phone == 1
    hidden = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert hidden[0] == "please use password=[SECRET] now" and hidden[1000] is None and hidden[1002] == "É [EMAIL]"
    assert pii.redacted(docs, model).columns == docs.columns and pii.redacted(docs, model).count() == docs.count()


def test_reliabilities_favour_good_labelers():
    patterns = [("+++000", 900.0), ("---000", 800.0), ("++-000", 60.0), ("--+000", 50.0), ("0+0000", 10.0)]
    post, table = pii.aggregate(patterns)
    assert post["+++000"] > 0.99 and post["---000"] < 0.01 and post["++-000"] > 0.5
    assert table[0][1][2] > table[0][0][2]


def test_nothing_to_learn(spark):
    empty = corpus(spark).limit(0)
    model = pii.learn(empty)
    assert model.weights == () and pii.find(empty, model).count() == 0
    assert pii.find(corpus(spark), model).filter("spans <> base").count() == 0


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op7_pii"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id] or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
