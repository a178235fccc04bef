"""Decontamination next to a plain version of the same rules, and re-parameterised questions."""

from collections import defaultdict

import regex

from pulsegrid.llm import decontaminate as d
from pulsegrid.llm.queries import QUERIES

DOCS = "doc_id long, text string, item_id string, row long, found string"
ITEM = "A train leaves the old station at 40 km per hour and a second train follows it after 3 hours, when do both trains of Mary Jones meet 40 miles on?"


UNSPACED = rf"[{d.UNSPACED}]"
TOKEN = "[\1-\4][^\5]*\5|" + rf"(?:(?!{UNSPACED})\p{{L}})+|{UNSPACED}"


def plain_tokens(text):
    t = text.translate({ord(c): " " for c in "\1\2\3\4\5"})
    t = regex.sub(d.NUMBER, "\2\\g<0>\5", t)
    t = regex.sub(d.UNIT, "\\g<1>\3\\g<2>\5", t, flags=regex.I)
    t = regex.sub(d.NAME, "\1\\g<0>\5", t)
    t = regex.sub(d.INITIAL, "\4", t)
    return regex.findall(TOKEN, t.lower())


def said(token):
    return token[1:-1] if token < "\5" else token


def read(found, names):
    """Template: placeholders by kind; a word that begins a sentence as a word or as a name."""
    return tuple(t if t >= "\5" else ("\1" if names else said(t)) if t[0] == "\4" else t[0] for t in found)


def slots(found, names):
    return sum(t < ("\5" if names else "\4") for t in found)


def slot(token):
    return token[0].replace("\4", "\1") + said(token)


def plain(docs, items):
    """(document, item, windows) by the rules of the module, window by window."""
    index, whole, total, tokens = defaultdict(set), [], {}, {}
    for i, text in items:
        t = tokens[i] = plain_tokens(text or "")
        cuts = [t[p:p + d.WINDOW] for p in range(len(t) - d.WINDOW + 1)]
        usable = [p for p, w in enumerate(cuts) if slots(w, False) <= d.WINDOW - d.LITERALS]
        total[i] = len(usable)
        if t and (not usable or len(usable) < d.COVERAGE * len(cuts)):
            whole.append(i)
            continue
        for p in usable:
            for names in (False, True):
                if slots(cuts[p], names) <= d.WINDOW - d.LITERALS:
                    index[read(cuts[p], names)].add((i, p, slots(cuts[p], names) > 0))
    out = set()
    for k, text in docs:
        found = plain_tokens(text or "")
        hits = defaultdict(dict)
        for p in range(len(found) - d.WINDOW + 1):
            w = found[p:p + d.WINDOW]
            for i, q, slotted in {h for names in (False, True) for h in index.get(read(w, names), ())}:
                hits[i, p - q][q] = hits[i, p - q].get(q, True) and slotted
        for i in {i for i, _ in hits}:
            lines = {line: qs for (j, line), qs in hits.items() if j == i}
            values = {line: defaultdict(set) for line in lines}
            for line, qs in lines.items():
                for at in {q + n for q, slotted in qs.items() if slotted for n in range(d.WINDOW)}:
                    if tokens[i][at] < "\5":
                        values[line][slot(tokens[i][at])].add(said(found[at + line]))
            torn = {line for line, v in values.items() if any(len(x) > 1 for x in v.values())}
            leading = {}
            for line in sorted(lines, key=lambda x: (x not in torn, len(lines[x]), -x)):
                leading |= {s: min(v) for s, v in values[line].items()}
            kept = [line for line in lines if line not in torn and all(leading[s] == min(v) for s, v in values[line].items())]
            n = len({q for line in kept for q in lines[line]})
            if n and n >= d.COVERAGE * total[i]:
                out.add((k, i, n))
        for i in whole:
            t, n = tokens[i], len(tokens[i])
            for line in range(len(found) - n + 1):
                f = found[line:line + n]
                alike = [names for names in (False, True) if n - slots(t, names) >= d.LITERALS and read(t, names) == read(f, names)]
                one = lambda names: all(len({said(y) for x, y in zip(t, f) if x < "\5\4"[not names] and slot(x) == s}) == 1
                                        for s in {slot(x) for x in t if x < "\5\4"[not names]})
                same = read(t, False) == read(f, False) and list(map(said, t)) == list(map(said, f)) and (n >= d.LITERALS or len(found) == n)
                if same or any(one(names) for names in alike):
                    out.add((k, i, 1))
    return out


def test_cases(spark):
    again = ITEM.replace("40", "55").replace("Mary Jones", "John Smith").replace("3", "7")
    torn = ITEM.replace("40 km", "55 km").replace("40 miles", "56 miles").replace("Mary Jones", "John Smith")
    docs = [(1, f"Some text first. {ITEM} And more."), (2, f"words {again} words"), (3, torn), (4, None), (5, ""), (6, "unlike anything " * 20_000),
            (7, " ".join(ITEM.split()[:9])), (1, f"Some text first. {ITEM} And more."), (None, ITEM), (8, "1 2 3 4 5 6 7 8 " * 50)]
    items = [(1, ITEM), (1, ITEM), (2, None), (3, "too short"), (4, ""), (5, "1 2 3 4 5 6 7 8"), (6, " ".join(ITEM.split()[8:]))]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in docs], DOCS)
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = d.matches(frame, bench).collect()
    assert {(r.doc_id, r.item_id, r.windows) for r in got} == plain(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    by = {(r.doc_id, r.item_id): r for r in got}
    assert not by[1, 1].reworded and by[2, 1].reworded and (None, 1) in by and (8, 5) in by and (7, 1) not in by
    assert by[2, 1].coverage > 0.8 and ((3, 1) not in by or by[3, 1].windows < by[1, 1].windows)
    frame = frame.withColumnRenamed("row", "_row")
    kept = d.clean(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - {r.doc_id for r in got}
    for empty in (d.matches(frame.limit(0), bench), d.matches(frame, bench.limit(0))):
        assert empty.count() == 0
    assert d.clean(frame, bench.limit(0)).count() == len(docs)


def matched(spark, docs, items):
    got = d.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.windows) for r in got} == plain(docs, items)
    return {(r.doc_id, r.item_id): r for r in got}


def test_one_value_over_all_alignments(spark):
    """Two words put in between make two alignments; each is consistent by itself, but not with the other."""
    parts = ("the slow train runs at 40 km per hour through long valleys", "it then climbs by 40 km per hour over the high plain",
             "passengers who paid 40 km per hour sleep along the cold river")
    item = " and ".join(parts)
    whole = " and then, once again, ".join(x.replace("40", "55") for x in parts)
    torn = " and then, once again, ".join(x.replace("40", str(n)) for x, n in zip(parts, (55, 77, 99)))
    twice = item.replace("40", "55") + " . " + item.replace("40", "77")
    got = matched(spark, [(1, torn), (2, whole), (3, twice), (4, item)], [(1, item)])
    assert set(got) == {(2, 1), (3, 1), (4, 1)} and got[2, 1].reworded and got[3, 1].coverage == 1 and not got[4, 1].reworded
    # One of the three alignments alone is consistent, and all of a shorter item.
    assert matched(spark, [(1, torn)], [(1, parts[0])])[1, 1].coverage == 1


def test_names_that_begin_a_sentence(spark):
    item = "Anna sells 12 red cups. Anna keeps 3 of the cups for Tom and gives all others to her sister"
    again = item.replace("Anna", "Peter").replace("12", "50").replace("3", "8").replace("Tom", "Kim")
    inside = "They say that " + again.replace("cups. Peter", "cups. Peter") + " in the end"
    mixed = again.replace("Peter keeps", "Paula keeps")
    plainly = "we know that anna sells 12 red cups and so on"
    low = "When does the early bus leave the old town hall on Sunday morning"
    got = matched(spark, [(1, again), (2, inside), (3, mixed), (4, plainly), (5, "Tell me when does the early bus leave the old town hall on Monday morning"),
                          (6, "When Does The Early Bus Leave The Old Town Hall")], [(1, item), (2, low)])
    assert (1, 1) in got and got[1, 1].reworded and got[1, 1].coverage == 1 and (2, 1) in got and (5, 2) in got
    assert (4, 1) not in got and ((3, 1) not in got or got[3, 1].windows < got[1, 1].windows)


def test_random_texts(spark, rng):
    words = ["Anna", "Bob", "tom", "Tom", "sells", "red", "cups", "3", "5", "km", "USD", ".", ",", "the", "The", "A", "of", "北", "京", "x"]
    say = lambda n: " ".join(rng.choice(words, n))
    items = [(i, say(int(rng.integers(1, 14)))) for i in range(60)]
    docs = [(k, " ".join([say(6), *[items[i][1] for i in rng.integers(0, 60, 3)], say(5)])) for k in range(40)] + [(100 + i, t) for i, t in items[:20]]
    assert len(matched(spark, docs, items)) > 60


def test_many_places_in_one_text(spark):
    got = matched(spark, [(1, "1 2 3 4 5 6 7 8 9 " * 3000), (2, "why " * 5000), (3, "Why")], [(1, "3 4 5 6"), (2, "why"), (3, "Why? Why? Why?")])
    assert set(got) == {(1, 1), (3, 2), (2, 3)}


def test_long_runs_of_names_and_numbers(spark):
    """A list of many thousand names or numbers is one name or number; it does not cost the stack of the task that reads it."""
    item = "the early bus leaves the old town hall on Sunday morning"
    names = "it was written by " + "Anna Bob Tom " * 10_000
    numbers = "the numbers are " + ",".join(map(str, range(30_000))) + " and "
    got = matched(spark, [(1, names), (2, numbers), (3, f"{names}and {item}"), (4, numbers + item)], [(1, item)])
    assert set(got) == {(3, 1), (4, 1)}


def test_query(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id, r.windows) for r in QUERIES["op3_decontaminate"](spark, sf).collect()}
    assert got == plain(docs, items) and got
    held = {(k, i) for k, t in docs for i, b in items if " ".join(b.split()) in " ".join(t.split())}
    assert held <= {(k, i) for k, i, _ in got}


def test_main_path_is_native(spark, sf_dir):
    plan = QUERIES["op3_decontaminate"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
