import duckdb
import pandas as pd

from tests.llm.frames import empty, odd, odd_rows, prose
from tickfold.llm import oracle, templates


def corpus():
    banner = "Posted by user 4711 on 2024-01-05 under the usual terms and conditions of this site"
    texts = []
    for i in range(40):
        lines = [prose(1000 + 20 * i + k, 20 + k) for k in range(8)]
        lines.insert(i % 6, banner.replace("4711", str(i)).replace("05", f"{i % 28:02d}"))
        if i % 5 == 0:
            lines.insert(2, "Share this now")
        if i % 7 == 0:
            lines += ["", "   ", prose(7, 60)]
        texts.append("\n".join(lines))
    texts += [texts[0], texts[1], texts[1], texts[2] + "\n" + prose(77, 9)]  # copies
    texts += [f"alpha beta gamma {'red' if i % 2 else 'blue'} house on the long road number {i} by the sea" for i in range(12)]
    return [*texts, "", " \n ", "\n\n", "one line"]


def test_equals_its_statement(spark):
    rows = list(enumerate(corpus()))
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.sql(oracle.LINE_DEDUP).df().sort_values("doc_id")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = templates.drop_recurring(frame)[0].toPandas().sort_values("doc_id")
    assert got.values.tolist() == want[got.columns].values.tolist()
    assert got.n_dropped.sum() > 30


def test_what_goes_and_what_stays(spark):
    texts = corpus()
    got = {r.doc_id: r for r in templates.drop_recurring(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))[0].collect()}
    holders = [i for i in range(40) if "Posted by" in got[i].text]
    assert holders == [0]  # the first keeps it, whatever its share of the others
    assert [i for i in range(40) if prose(7, 60) in got[i].text] == [0]
    for i in range(1, 40):
        kept = got[i].text.split("\n")
        assert [x for x in texts[i].split("\n") if x in kept] == kept
        assert got[i].n_dropped == len(texts[i].split("\n")) - len(kept)
    # a copy loses what its original loses; another document what stood elsewhere before
    assert got[40].text == got[0].text and got[41].text == got[42].text == got[1].text
    assert got[43].text == prose(77, 9)


def test_long_token_without_digit_is_read_once(spark):
    line = "x" * 200_000 + " 7"
    out = templates.drop_recurring(spark.createDataFrame([(1, line), (2, line)], "doc_id long, text string"))[0]
    assert out.count() == 2


def test_odd_rows(spark):
    docs = odd(spark)
    out = templates.deduplicate_lines(docs)
    assert out.columns == docs.columns and out.count() == len(odd_rows())
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "")
    assert [r.text for r in sorted(out.collect(), key=key)] == [r.text for r in sorted(docs.collect(), key=key)]
    assert templates.deduplicate_lines(empty(spark)).count() == 0


def families():
    """Three families of lines in one leaf, ten lines each and all different, and lines that are alone."""
    tails = ("one and two make three as all know", "seen by night from a hill far away", "never sold nor lent at any fair price")
    texts = [f"alpha beta gamma {'x' * (i + 1)} stands {tail} here" for tail in tails for i in range(10)]
    return [*texts, *(f"alpha beta gamma {prose(900 + i, 9)}" for i in range(5))]


def test_a_leaf_holds_many_templates(spark):
    rows = list(enumerate(families()))
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.sql(oracle.LINE_DEDUP).df().sort_values("doc_id")
    got = templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))[0].toPandas().sort_values("doc_id")
    assert got.values.tolist() == want[got.columns].values.tolist()
    assert got.doc_id[got.n_dropped == 0].tolist() == [0, 10, 20, 30, 31, 32, 33, 34]  # the first of each family, and what is alone


def test_boilerplate_goes_whatever_its_share(spark):
    """Without sparing by share: lines stay in their first holder and in whole copies of it alone."""
    a, b, c = (prose(500 + i, 40) for i in range(3))
    texts = {1: f"{a}\nfirst own words", 2: f"{b}\nother own words", 3: f"{a}\n{b}\nthird document", 4: f"{a}\n{b}", 5: c, 6: c, 7: f"{a}\n{c}"}
    edited = " ".join(c.split()[:-6] + ["edited"] * 6)  # the line of document 5 by its template
    texts |= {10: f"{c}\nshort line of ten", 11: f"{edited}\nshort line of eleven"}
    texts |= {8: f"{a}\neight alone has this", 9: f"{a}\neight alone has this"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in templates.deduplicate_lines(docs).collect()}
    assert got[1] == texts[1] and got[2] == texts[2] and got[5] == got[6] == c
    assert got[3] == "third document"  # most of it, in two templates
    assert got[4] == got[7] == ""  # all of it, from different documents
    assert got[10] == "short line of ten" and got[11] == "short line of eleven"
    assert got[8] == got[9] == "eight alone has this"  # a copy loses what its original loses
