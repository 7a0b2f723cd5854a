import itertools
import random

import pytest

from orderflow.llm import queries
from orderflow.llm.filter_audit import FILTERS, audit, cells
from tests.compare import differences, duck

DOCS = "doc_id long, text string, lang string, part string, mask int, n long, good boolean, id string"
LABELS = "doc_id long, quality int, toxic int, part string"
GOOD = " ".join(f"word{k}" for k in range(120))


def sql_rows(found, sql, tables):
    """Differences between Spark rows and SQL over these tables."""
    con = duck("/root/testdata/sf0.001")
    for name, (columns, rows) in tables.items():
        con.execute(f"CREATE OR REPLACE TEMP TABLE {name}({columns})")
        for row in rows:
            con.execute(f"INSERT INTO {name} VALUES ({', '.join('?' * len(row))})", list(row))
    return differences(found, con, sql)


def fails(text, copy):
    text = text or ""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text), "E": copy,
    }


def brute(docs, labels):
    """Every order, document by document."""
    marks = {}
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            a, b = marks.get(doc_id, (False, False))
            marks[doc_id] = (a or quality == 1, b or toxic == 1)
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    judged = []
    for doc_id, text, part in docs:
        f = fails(text, doc_id is not None and least[text or ""] < doc_id)
        judged.append((part or "", {x for x in FILTERS if f[x]}, *marks.get(doc_id, (False, False))))
    out = {}
    for part in {j[0] for j in judged}:
        mine, shapley = [j for j in judged if j[0] == part], dict.fromkeys(FILTERS, 0)
        for order in map("".join, itertools.permutations(FILTERS)):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [j for j in left if x in j[1]]
                redundant = sum(x in j[1] for j in mine) - len(gone)
                left = [j for j in left if x not in j[1]]
                shapley[x] += len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(j[1] == {x} for j in mine),
                                          sum(j[2] for j in gone), sum(j[3] for j in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def made(seed, n=150):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", GOOD, GOOD + " #", GOOD.upper(), "a b " * 80, "Same Text", "x " * 30_000, GOOD + "\x0bend", "é" * 50]
    docs = [(rng.choice([None, k, k, k]), rng.choice(texts), rng.choice(["en", "de", "", None])) for k in range(n)]
    docs += docs[:10]
    labels = [(rng.choice([None, k]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, n, 2)]
    return docs, labels + labels[:20] + [(1, 1, 0), (1, 0, 1)]


def frames(spark, docs, labels):
    wide = [(*d, "clash", 3, 4, True, "x") for d in docs]
    return spark.createDataFrame(wide, DOCS).repartition(4), spark.createDataFrame([(*x, "p") for x in labels], LABELS)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_order_by_hand(spark, seed):
    docs, labels = made(seed)
    rows = audit(*frames(spark, docs, labels)).collect()
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in rows}
    assert len(rows) == len(got) == 600 * len({d[2] or "" for d in docs})
    assert got == brute(docs, labels)


def test_shapley_shares_add_up_to_all_removed(spark):
    docs, labels = made(3)
    rows = audit(*frames(spark, docs, labels)).collect()
    for part in {r["part"] for r in rows}:
        mine = [r for r in rows if r["part"] == part]
        assert sum({r["filter_order"][r["step"] - 1]: r["shapley"] for r in mine}.values()) == sum(r["removed"] for r in mine)


def test_one_text_in_most_rows_is_few_cells(spark):
    docs = [(k, "Same Text", "en") for k in range(3000)]
    got = {(r["mask"], r["n"]) for r in cells(*frames(spark, docs, [])).collect()}
    assert got == {(0b00101, 1), (0b10101, 2999)}


def test_no_rows(spark):
    assert audit(*frames(spark, [], [])).collect() == []


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    docs, labels = made(4)
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    tables = {"documents": ("doc_id BIGINT, text VARCHAR, lang VARCHAR", docs),
              "labels": ("doc_id BIGINT, quality INT, toxic INT", labels)}
    assert sql_rows(queries.op13_filter_audit(spark, str(tmp_path)), queries.ORACLE["op13_filter_audit"], tables) is None
