import hashlib
import re

import pytest
from pyspark.sql import functions as F

from orderflow.llm import queries
from orderflow.llm.fill_middle import cuts, infilled, restored
from tests.llm.test_filter_audit import sql_rows

TEXTS = [
    None, "", " ", "word", "a b", "é中\U0001f600 x", "tab\tline\nend\r\n", "has <P> inside", "<S>", "x<M>", "<P", "<<S", "P>a<",
    "same text here", "same text here", "ZzÀ-9 mixed_UP", "\x00nul",
]
COLUMNS = "doc_id long, text string, n int, form string, digest string, h1 string, cut string"


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", text, None, None
    if h[3] % 100 < 20:
        return len(units), "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return len(units), "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def test_cuts_are_read_off_one_match():
    assert cuts("ab c", 1, 3) == (3, 2, 4)
    assert cuts("ab c", 7, 4) == (3, 0, 4) and cuts("", 5, 9) == (0, 0, 0)


def test_against_brute_force(spark):
    rows = [(None if k % 23 == 22 else k, TEXTS[k % len(TEXTS)], 1, "psm", "d", "h", "c") for k in range(17 * 30)]
    rows.append((10**15, "word, " * 60_000, 0, "", "", "", ""))
    rows.append((10**15 + 1, "-" * 300_000, 0, "", "", "", ""))
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    found = infilled(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    got = [(r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"], r["back"]) for r in found]
    want = [(r[0], *brute(r[0], r[1]), r[1] or "") for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {"plain", "psm", "spm"} == {r["form"] for r in found}


def test_other_parameters(spark):
    docs = spark.createDataFrame([(k, f"some words {k} and more") for k in range(60)], "id long, body string")
    all_changed = infilled(docs, "id", "body", seed=7, changed=100, suffix_first=0).collect()
    assert {r["form"] for r in all_changed} == {"psm"}
    assert {r["form"] for r in infilled(docs, "id", "body", changed=0).collect()} == {"plain"}


def test_no_rows(spark):
    assert infilled(spark.createDataFrame([], COLUMNS)).collect() == []


@pytest.mark.parametrize("none", [False, True])
def test_sql_agrees_on_odd_texts(spark, none, tmp_path):
    rows = [] if none else [(k if k % 9 else None, t) for k, t in enumerate(TEXTS * 4) if t != "\x00nul"]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_fill_middle(spark, str(tmp_path))
    assert sql_rows(got, queries.ORACLE["op11_fill_middle"], {"documents": ("doc_id BIGINT, text VARCHAR", rows)}) is None
