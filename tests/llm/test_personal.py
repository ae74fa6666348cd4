import random

from brute import personal
from fixtures import awkward, documents, sentence
from pyspark.sql import functions as F

from opinara.llm.personal import personal_spans, sanitise

CASES = ["a.b@c.de", "x@y", "a@b.c@d.e.f", "😀 me@x.org, 1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
         "+49 (30) 1234-567 89", "+1+2 345678901", "....@a.b-c.d_e@f.gg", "0" * 3000, "a" * 3000, "1." * 4000, "a." * 3000 + "@x.yy" + ".z" * 9000,
         "+1(" * 2000, "9 " * 5000, "u@h.c\nv@h.c", "0000000000000", "5500005555555559 5500005555555559"]


def spans(df):
    return {r["doc_id"]: r for r in personal_spans(df).collect()}


def test_patterns_find_what_plain_ones_find(spark):
    rnd = random.Random(8)
    texts = CASES + ["".join(rnd.choice("a1.@+- (0_%\né") for _ in range(rnd.randrange(200))) for _ in range(400)]
    rows = [*enumerate(texts), (9001, None), (9002, "")]
    out = spans(documents(spark, rows))
    for i, text in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in out[i]["base"]] == personal(text), text
        assert all((text or "")[s["start"]:s["end"]] == s["value"] for s in out[i]["base"])


def told(spark, n=30):
    rnd = random.Random(3)
    rows = [(i, sentence(rnd, 20) + f" the Zanzibar office of boss@corp.example said {sentence(rnd, 5)}") for i in range(8)]
    rows += [(100 + i, f"the office said {sentence(rnd, 20)}") for i in range(n)]
    return rows


def test_terms_that_tell_an_entity_go(spark):
    rows = told(spark)
    out = spans(documents(spark, rows))
    for i, text in rows[:8]:
        terms = {text[t["start"]:t["end"]] for t in out[i]["terms"]}
        assert "Zanzibar" in terms and "the" not in terms and "office" not in terms
    assert all(not out[i]["terms"] for i, _ in rows[8:])
    clean = {r["doc_id"]: r["text"] for r in sanitise(documents(spark, rows)).collect()}
    assert all("Zanzibar" not in clean[i] and "boss@" not in clean[i] and "<EMAIL>" in clean[i] for i, _ in rows[:8])
    assert all(clean[i] == text for i, text in rows[8:])


def test_copies_are_no_further_evidence(spark):
    rows = [(i, "the Zanzibar office of boss@corp.example said") for i in range(9)] + [(100 + i, f"some text {i}") for i in range(30)]
    assert all(not r["terms"] for r in spans(documents(spark, rows)).values())


def test_entities_of_one_or_two_texts_are_weighed(spark):
    rows = [(0, "the Zanzibar office of boss@corp.example said"), (1, "call Timbuktu office of +49 30 1234567 today"), (2, "the Timbuktu people at +49 30 1234567 said")]
    rows += [(100 + i, f"the office people said call today {i}") for i in range(97)]
    out = spans(documents(spark, rows))
    for (i, text), term in zip(rows, ["Zanzibar", "Timbuktu", "Timbuktu"]):
        assert [text[t["start"]:t["end"]] for t in out[i]["terms"]] == [term]
    clean = {r["doc_id"]: r["text"] for r in sanitise(documents(spark, rows)).collect()}
    assert clean[0] == "the <TERM> office of <EMAIL> said"
    assert all(not out[i]["terms"] and clean[i] == text for i, text in rows[3:])


def test_terms_of_the_whole_text_go(spark):
    rnd = random.Random(5)
    far = " and the people".join([""] * 30)
    rows = [(i, f"Zanzibar office{far} of boss@corp.example{far} said zanzibar\n{sentence(rnd, 5)} Kilwa{i % 2}Pemba") for i in range(3)]
    rows += [(100 + i, f"the office and people said of all, edge{'x' * (i % 3)} {i}") for i in range(97)]
    out = spans(documents(spark, rows))
    for i, text in rows[:3]:
        assert [text[t["start"]:t["end"]] for t in out[i]["terms"]] == ["Zanzibar", "zanzibar", "Kilwa", "Pemba"]
    assert all(not out[i]["terms"] for i, _ in rows[3:])


def test_an_entity_of_all_texts_is_told_by_nothing(spark):
    rows = [(i, f"the Zanzibar office of boss@corp.example said {i}") for i in range(5)]
    assert all(not r["terms"] for r in spans(documents(spark, rows)).values())


def test_awkward_rows(spark):
    rows = [*awkward(), (None, "n@u.ll"), (1, "t@w.ce"), (1, "t@w.ce")]
    df = documents(spark, rows).withColumn("base", F.lit(1)).withColumn("span_id", F.lit(2))
    assert personal_spans(df).count() == len(rows)
    clean = sanitise(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    assert clean.where("text = '<EMAIL>'").count() == 3 and clean.where("text IS NULL").count() == 1
    empty = documents(spark, [])
    assert personal_spans(empty).count() == 0 and sanitise(empty).count() == 0
    plan = personal_spans(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
