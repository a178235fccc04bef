"""Items dense in numbers, units or names, short ones, and scripts without blanks."""

from pulsegrid.llm import decontaminate as d

TRAIN = "A train travels 60 km in 2 hours and 30 km in 3 hours"
RUN = "we met Ann, Bob, Cid, Dan and 3 more, then 4 kg, 5 kg, 6 kg, 7 kg"


def test_dense_and_short_items(spark):
    again = TRAIN.replace("60", "80").replace("30", "40").replace("2 hours", "5 hours")
    torn = "A train travels 60 km in 2 hours and 30 km in 2 hours"
    docs = [(1, f"Question: {TRAIN}. And more."), (2, f"so: {again}."), (3, torn), (4, "A train travels 60 km in rain and 30 km in snow"),
            (5, "counted 1 2 3 4 5 6 7 8 9"), (6, "counted 2 3 4 5 6 7 8 9 9"), (7, "They asked who wrote Hamlet. And when"), (8, "Why?"), (9, "but why not"),
            (10, "问题北京是中国的首都吗答案"), (11, "北方和南方"), (12, "Adding 4 to 5 gives what"), (13, RUN), (14, None), (15, ""), (None, TRAIN), (1, f"Question: {TRAIN}. And more.")]
    items = [(1, TRAIN), (2, "1 2 3 4 5 6 7 8"), (3, "who wrote Hamlet"), (4, "Why"), (5, "北京是中国的首都吗"), (6, "Adding 1 to 2 gives"), (7, RUN), (8, None), (9, ""), (1, TRAIN)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.matches(frame, bench).collect()}
    # The copy with another value for one of two equal ones is not consistent; TRAIN has 2 and 3 hours, torn 2 and 2, which is.
    assert set(got) == {(1, 1), (2, 1), (3, 1), (None, 1), (5, 2), (7, 3), (8, 4), (10, 5), (12, 6), (13, 7)}
    assert got[2, 1].reworded and not got[1, 1].reworded and got[1, 1].coverage == 1
    back = spark.createDataFrame([(1, torn)], "item_id long, text string")
    assert d.matches(frame.filter("doc_id = 1"), back).count() == 0
    assert {r.doc_id for r in d.clean(frame, bench).collect()} == {4, 6, 9, 11, 14, 15}
