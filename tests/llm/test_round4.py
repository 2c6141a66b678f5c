"""Joins of corpus operators whose sides grow with the input."""

import re

from sketchloom.llm import components, spotsigs


def test_growing_tables_are_not_broadcast(spark, monkeypatch):
    plans = []

    def noting(f):
        def write(df, name):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return f(df, name)

        return write

    for module, name in ((spotsigs, "kept"), (spotsigs, "written"), (components, "written")):
        monkeypatch.setattr(module, name, noting(getattr(module, name)))
    text = "the quick fox is a clever one and the lazy dog sleeps in the warm sun near a river {} the end of it was seen by all people"
    docs = spark.createDataFrame([(i, text.format(i // 3)) for i in range(30)], "doc_id long, text string")
    classes = spotsigs.spot_classes(docs)
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in (classes, spotsigs.fingerprint_report(docs))]
    joins = [line for plan in plans for line in re.findall(r"(?:Broadcast\w+|SortMerge|ShuffledHash)Join.*", plan)]
    assert len(joins) > 20
    # bitmaps of 2 MB at most, and one row for each range of the order
    assert [x for x in joins if x.startswith("Broadcast") and "_mi_bucket" not in x and "[part" not in x] == []
    assert classes.count() == 30
