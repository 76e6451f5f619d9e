"""Decontamination: re-parameterised questions, slot consistency, chance agreement, odd rows, the SQL twin."""

from check_oracle import compare, connect

from latewatch.llm import decontaminate as D
from latewatch.llm import queries

ITEM = "a train leaves the old town at 60 km per hour and after 3 hours it meets Anna who left at 40 km per hour how far"
FILL = "words that have nothing to do with it stand here and there in a row"


def leaks(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string, template string, d int")
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.leaks(docs, items).collect()}


def test_templates(spark):
    docs = {
        1: f"{FILL}. {ITEM}. {FILL}", 2: ITEM.replace("60", "75").replace("3 hours", "4 days").replace("Anna", "Bert"), 3: ITEM.upper().lower(), 4: FILL,
        5: ITEM.replace(" and ", ", and\n"), 6: "at 60 km per hour and", 7: " ".join(ITEM.split()[:16]), 8: None, 9: "", 10: "1 2 3 4 5 6 7 8 9 10 11 12",
    }
    got = leaks(spark, [(k, t, "x", 0) for k, t in docs.items()] + [(1, docs[1], "x", 0), (None, ITEM, "x", 0)], [(7, ITEM), (8, "60 40 20 10 5 4 3 2 1"), (9, "too short"), (10, None)])
    assert {k for k in got if k[1] == 7} == {(d, 7) for d in (1, 2, 3, 5, 7, None)}
    assert got[2, 7].changed and not got[1, 7].changed and not got[None, 7].changed
    assert {k for k in got if k[1] != 7} == set()  # numbers alone need equal slots


def test_slots_must_be_consistent(spark):
    item = "if 5 apples cost 10 coins and 5 pears cost 10 coins then what do 5 plums cost in all"
    same = item.replace("5", "7").replace("10", "30")
    torn = "if 1 apples cost 10 coins and 2 pears cost 11 coins then what do 3 plums cost in all"
    got = leaks(spark, [(1, same, "", 0), (2, torn, "", 0)], [(1, item)])
    assert set(got) == {(1, 1)} and got[1, 1].changed


def test_one_other_value_does_not_hide_a_copy(spark):
    """A verbatim copy in which one of two equal values differs keeps its equal windows; so does a re-parameterised one the windows of the value in most of them."""
    item = f"the library lends a book for 5 days and {FILL} but a film must be brought back within 5 days or the reader pays a fine to the desk near the door"
    one, other = item.replace("within 5", "within 6"), item.replace("for 5", "for 8").replace("within 5", "within 9")
    got = leaks(spark, [(1, item, "", 0), (2, one, "", 0), (3, other, "", 0)], [(1, item)])
    assert set(got) == {(1, 1), (2, 1), (3, 1)}
    assert not got[1, 1].changed and got[3, 1].changed
    assert got[2, 1].n_matched >= got[2, 1].n_windows - D.WINDOW


def test_names_that_open_sentences(spark):
    item = "Tom buys 3 pens. Ann buys 4 pens. Tom gives Ann 2 pens. How many pens does Tom have?"
    other = item.replace("Tom", "Max").replace("Ann", "Eva").replace("3", "7").replace("4", "9").replace("2", "5")
    docs = {1: item, 2: other, 3: f"{FILL}. {other} {FILL}", 4: "Tom likes tea. Ann likes milk. Tom meets Ann at 2 today. How many cups does Tom want?"}
    got = leaks(spark, [(k, t, "", 0) for k, t in docs.items()], [(1, item)])
    assert set(got) == {(1, 1), (2, 1), (3, 1)}
    assert not got[1, 1].changed and got[2, 1].changed and got[2, 1].n_matched == got[2, 1].n_windows == len(item.split()) - D.WINDOW + 1


def test_any_window_holds_a_seed(spark):
    """Every offset of a short shared passage is found, whatever stands before it."""
    item = "alpha beta gamma delta epsilon zeta eta theta"
    got = leaks(spark, [(k, f"{'pre ' * k}{item} post post", "", 0) for k in range(9)], [(1, item)])
    assert len(got) == 9


def test_stage_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM, "en"), (2, FILL, "en"), (2, FILL, "en"), (None, FILL, None)], "doc_id long, text string, k string")
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "2", "None"]
    assert D.keep_clean(docs, items.limit(0)).count() == 4 and D.leaks(docs.limit(0), items).count() == 0


def test_twin(spark, sf):
    df = queries.op3_decontaminate(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare(df, connect(sf), queries.SQL["op3_decontaminate"]) == ""
