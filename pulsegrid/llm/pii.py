"""Personal data by fixed rules, and further spans by weak supervision.

Base spans (email, ip, card, phone) follow fixed rules and always stay. Beyond
them, loose patterns propose candidate spans. Labelers vote on each candidate:
for (+), against (-) or not at all (0); some look at its form (regular
expressions), some for words of a gazetteer before it, some at its context.
Expectation-maximisation over the counted vote patterns of the whole corpus
estimates how reliable each labeler is; the posteriors train a logistic
classifier on the candidates' features, which decides about every candidate.
Only counts reach the driver: vote patterns and features are drawn from short fixed lists.

Defined results: a null text is an empty one; ids are kept as they are, repeated
or null; offsets are code points; a candidate that overlaps a base span or an
earlier candidate is no candidate; without candidates there are only base spans.
Spelled-out addresses ("a at b dot c") are looked for with parts of mail's own limits: 64 characters
before the sign, 63 in each part of the domain, of which there are two to five.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_rows, utf8

#: The kinds of base spans in their order, then those the classifier may add.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("address", "number", "person", "secret")
ORDER = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}
#: A candidate is added from this probability on.
THRESHOLD = 0.9
EM_ROUNDS = 100
FIT_ROUNDS = 300
#: What the counts weigh together in the fit, whatever the size of the corpus.
FIT_WEIGHT = 10_000.0

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Nothing can match from inside a run of digits that does not match from its start.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANY_BASE = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches, in time linear in the text: each ``@`` is looked at once."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append(("email", start, match.end()))
            last = match.end()
        at = text.find("@", max(at + 1, last))
    return out


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and then start."""
    if not ANY_BASE.search(text):
        return []
    out = emails(text)
    for m in IP.finditer(text):
        # Long numbers are no parts; their length decides before they are read.
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# Loose patterns. Runs are taken whole (atomic groups), so none is read twice.
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])(?>[A-Za-z0-9+/_-]{12,})")
NUMBER = re.compile(r"(?<![\w+.])(?>\(?[0-9][0-9 ()./-]*)")
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}){1,4}", re.I)
PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Mme|Monsieur|Madame)\.? ((?:[^\W\d_]+[ -]){0,2}[^\W\d_]+)")

# Gazetteers: words that stand before personal data, and words that stand before other strings of that form.
CUES = {
    "secret": ("password", "passwd", "pwd", "passwort", "contraseña", "token", "secret", "api_key", "apikey", "api-key", "access_key",
               "auth", "bearer", "credential", "private_key"),
    "number": ("tel", "phone", "telefon", "teléfono", "téléphone", "call", "fax", "mobile", "handy", "ssn", "iban", "account", "konto",
               "cuenta", "compte", "card", "passport"),
    "address": ("mail", "email", "e-mail", "correo", "contact", "kontakt", "write"),
    "person": ("dear", "signed", "patient", "client", "customer", "lieber", "liebe", "estimado", "cher"),
}
OTHER_CUES = ("sha", "md5", "commit", "checksum", "hash", "version", "isbn", "issn", "doi", "page", "chapter", "vol", "build", "uuid", "figure", "table")
KNOWN_KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}")
KNOWN_NUMBER = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|0[0-9]{1,4}[ /-][0-9][0-9 -]{4,10}[0-9]")
DATE = re.compile(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}")
WORDISH = re.compile(r"[a-z]{5,}|[A-Z][a-z]{4,}")


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """What loose patterns propose beside the spans already taken."""
    found: list[Span] = []
    if ANY_BASE.search(text):
        for m in KEY.finditer(text):
            n = sum("0" <= c <= "9" for c in m[0])
            if 3 <= n <= len(m[0]) - 3:
                found.append(("secret", *m.span()))
        for m in NUMBER.finditer(text):
            end = m.end() - (len(m[0]) - len(m[0].rstrip(" ()./-")))
            if 7 <= len(digits_of(text[m.start():end])) <= 19 and not text[end:end + 1].isalnum():
                found.append(("number", m.start(), end))
    if "dot" in text or "DOT" in text:
        found += [("address", *m.span()) for m in SPELLED.finditer(text)]
    for m in PERSON.finditer(text):
        words = [w for w in re.split("[ -]", m[1]) if w[:1].isupper()]
        if words and m[1].startswith(words[0]):
            last = m[1].rfind(words[-1]) if all(w[:1].isupper() for w in re.split("[ -]", m[1])) else None
            found.append(("person", m.start(1), m.end(1) if last is not None else m.start(1) + len(words[0])))
    spans = sorted((a, b) for _, a, b in taken)
    out, at, reach = [], 0, 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        while at < len(spans) and spans[at][1] <= a:
            at += 1
        if a >= reach and (at == len(spans) or spans[at][0] >= b):
            out.append((kind, a, b))
            reach = b
    return out


def _known_form(kind: str, span: str, before: str, after: str) -> str:
    known = {"secret": KNOWN_KEY, "number": KNOWN_NUMBER}.get(kind)
    if kind == "number" and DATE.fullmatch(span):
        return "-"
    return "+" if known and known.fullmatch(span) or kind == "address" and re.search(r"[(\[]at[)\]]", span, re.I) else "0"


def _cue(kind: str, span: str, before: str, after: str) -> str:
    return "+" if any(w in before.lower() for w in CUES[kind]) else "0"


def _other_cue(kind: str, span: str, before: str, after: str) -> str:
    words = re.findall(r"[^\W\d_]+[0-9]*", before.lower())
    return "-" if words and words[-1].rstrip("0123456789") in OTHER_CUES or words and words[-1] in OTHER_CUES else "0"


def _random_look(kind: str, span: str, before: str, after: str) -> str:
    if kind == "secret":
        return "-" if WORDISH.search(span) or len(set(span)) < 8 else "+"
    if kind == "number":
        return "-" if len(set(digits_of(span))) < 3 else "0"
    return "0"


def _context(kind: str, span: str, before: str, after: str) -> str:
    if before[-1:] in "/\\" and before or re.search(r"https?:\S*$", before):
        return "-"
    return "+" if re.search(r"""[=:]\s*["']?$""", before) else "0"


def _checksum(kind: str, span: str, before: str, after: str) -> str:
    if kind != "number":
        return "0"
    d = digits_of(span)
    return "+" if len(d) in (15, 16) and luhn(d) else "0"


LABELERS = (_known_form, _cue, _other_cue, _random_look, _context, _checksum)


def votes(text: str, span: Span) -> str:
    kind, a, b = span
    before, after = text[max(0, a - 24):a], text[b:b + 8]
    return "".join(labeler(kind, text[a:b], before, after) for labeler in LABELERS)


def features(text: str, span: Span) -> tuple[str, ...]:
    """Features of a candidate for the classifier; each takes one of a few values."""
    kind, a, b = span
    s = text[a:b]
    nd, nu, nl = sum(c.isdigit() for c in s), sum(c.isupper() for c in s), sum(c.islower() for c in s)
    prior, after = text[max(0, a - 1):a], text[b:b + 1]
    shape = lambda c: "none" if not c else "space" if c.isspace() else "word" if c.isalnum() else c if c in "=:\"'/(" else "mark"
    return (
        f"kind={kind}", f"{kind}:len={min(5, len(s) // 8)}", f"{kind}:digits={min(4, 5 * nd // len(s))}",
        f"{kind}:case={(nu > 0) + 2 * (nl > 0)}", f"{kind}:hex={set(s.lower()) <= set('0123456789abcdef')}",
        f"{kind}:distinct={min(3, len(set(s)) // 4)}", f"before={shape(prior)}", f"after={shape(after)}",
        f"{kind}:cue={_cue(kind, s, text[max(0, a - 24):a], '')}",
    )


@dataclass(frozen=True)
class SpanModel:
    weights: tuple[tuple[str, float], ...]
    #: P(vote | other), P(vote | personal) of each labeler, votes in the order "-0+".
    reliabilities: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...] = ()
    threshold: float = THRESHOLD


def aggregate(patterns: list[tuple[str, float]], rounds: int = EM_ROUNDS) -> tuple[dict[str, float], tuple]:
    """Posterior of each counted vote pattern and the labelers' reliabilities, by expectation-maximisation.

    It starts from the majority of votes; every labeler keeps a little of each vote in
    each class, and a positive vote never counts against a span on balance.
    """
    codes = np.array([["-0+".index(v) for v in p] for p, _ in patterns])
    weight = np.array([n for _, n in patterns], dtype=float)
    lean = (codes - 1).sum(1)
    post = 1 / (1 + np.exp(-2.0 * lean))
    for _ in range(rounds):
        like = np.zeros((len(codes), 2))
        prior = np.clip((post * weight).sum() / weight.sum(), 0.05, 0.95)
        table = []
        for j in range(codes.shape[1]):
            rows = []
            for k, share in enumerate((1 - post, post)):
                n = np.bincount(codes[:, j], share * weight, 3) + (np.array([2.0, 2.0, 1.0]) if k == 0 else np.array([1.0, 2.0, 2.0]))
                rows.append(n / n.sum())
                like[:, k] += np.log(rows[-1][codes[:, j]])
            table.append(tuple(map(tuple, rows)))
        new = 1 / (1 + np.exp(np.clip(like[:, 0] + np.log(1 - prior) - like[:, 1] - np.log(prior), -50, 50)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    # A span without a vote for it stays out, whatever the classes came to mean.
    post = np.where(lean <= 0, np.minimum(post, 0.5 * (lean == 0)), post)
    return {p: float(x) for (p, _), x in zip(patterns, post)}, tuple(table)


def fit(rows: list[tuple[tuple[str, ...], float, float]], rounds: int = FIT_ROUNDS) -> tuple[tuple[str, float], ...]:
    """Logistic regression on counted feature tuples (features, count, posterior), by Newton steps with a ridge."""
    names = sorted({f for fs, _, _ in rows for f in fs})
    index = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for r, (fs, _, _) in enumerate(rows):
        x[r, [index[f] for f in fs]] = 1
    n, y = np.array([c for _, c, _ in rows], float), np.array([p for _, _, p in rows])
    # The ridge weighs the same against a large corpus as against a small one of the same proportions.
    n = n / n.sum() * FIT_WEIGHT
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (n * (y - p)) - 0.1 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(zip([*names, "_bias"], w.tolist()))


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(utf8(text).alias("_text"))


def learn(docs: DataFrame, *, text: str = "text") -> SpanModel:
    """Count vote patterns and features of all candidates in ``docs`` and fit the model to the counts."""
    def work(batch):
        seen: Counter = Counter()
        for raw in batch["_text"]:
            t = raw.as_py().decode("utf-8", "replace")
            for span in candidates(t, base_spans(t)):
                seen[votes(t, span), "\t".join(features(t, span))] += 1
        return {"votes": [v for v, _ in seen], "features": [f for _, f in seen], "n": pa.array(list(seen.values()), pa.int64())}
    counted = map_rows(_texts(docs, text), "votes string, features string, n long", lambda: work)
    # Both columns come from fixed lists, so the table is short however large the corpus.
    rows = counted.groupBy("votes", "features").agg(F.sum("n").alias("n")).orderBy("votes", "features").collect()
    if not rows:
        return SpanModel(())
    patterns: Counter = Counter()
    for r in rows:
        patterns[r.votes] += r.n
    post, reliabilities = aggregate(sorted(patterns.items()))
    return SpanModel(fit([(tuple(r.features.split("\t")), r.n, post[r.votes]) for r in rows]), reliabilities)


def added_spans(text: str, base: list[Span], model: SpanModel, weights: dict[str, float]) -> list[Span]:
    """Candidates the classifier accepts. A feature it never met counts nothing."""
    if not weights:
        return []
    out = []
    for span in candidates(text, base):
        z = weights["_bias"] + sum(weights.get(f, 0.0) for f in features(text, span))
        if 1 / (1 + np.exp(-z)) >= model.threshold:
            out.append(span)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (ORDER[s[0]], s[1])))


def find(docs: DataFrame, model: SpanModel, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, counts of base spans, ``base`` and ``spans`` as kind:start:end, comma-joined."""
    weights = dict(model.weights)

    def work(batch):
        out: dict = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base", "spans")}
        for raw in batch["_text"]:
            t = raw.as_py().decode("utf-8", "replace")
            base = base_spans(t)
            for kind in BASE_KINDS:
                out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
            out["base"].append(joined(base))
            out["spans"].append(joined(base + added_spans(t, base, model, weights)))
        return out | {"doc_id": batch["_id"]}
    return map_rows(docs.select(F.col(id).cast("long").alias("_id"), utf8(text).alias("_text")),
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string", lambda: work)


def redact(text: str, spans: list[Span]) -> str:
    """Every span becomes its kind in brackets; spans that overlap become one, of the first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], ORDER[s[0]])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: SpanModel, *, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null texts stay null and other columns pass through."""
    weights = dict(model.weights)
    names = docs.columns

    def work(batch):
        texts = []
        for raw in batch[text]:
            t = raw.as_py()
            if t is not None:
                t = t.decode("utf-8", "replace")
                base = base_spans(t)
                t = redact(t, base + added_spans(t, base, model, weights))
            texts.append(t)
        return {n: texts if n == text else batch[n] for n in names}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(docs.withColumn(text, F.col(text).cast("binary")), schema, lambda: work)
