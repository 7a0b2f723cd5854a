import json
import random

from pyspark.sql import functions as F

from orderflow.functions import jsons, variants
from orderflow.plans.function_queries import NESTED


def flat(text):
    """The same by recursion; of one key the deepest, last place counts, as members are sorted by name."""
    out = []

    def scalar(x):
        return json.dumps(x, separators=(",", ":"), sort_keys=True, ensure_ascii=False) if isinstance(x, list) else str(x).lower() if isinstance(x, bool) else str(x)

    def members(value, parent, path):
        for k, name in enumerate(sorted(value)):
            x, at = value[name], (*path, k)
            if isinstance(x, dict):
                members(x, name, at)
            elif isinstance(x, list):
                for i, y in enumerate(x):
                    if isinstance(y, dict):
                        members(y, f"{name}_{i}", (*at, i))
                    elif y is not None:
                        out.append(((*at, i), f"{name}_{i}", scalar(y)))
            elif x is not None:
                out.append((at, name if parent is None else f"{parent}_{name}", scalar(x)))

    try:
        root = json.loads(text)
    except (TypeError, ValueError):
        return {}
    if isinstance(root, dict):
        members(root, None, ())
    return {key: value for _, key, value in sorted(out)}


def made(rng, depth):
    if depth and rng.random() < 0.6:
        if rng.random() < 0.5:
            return {rng.choice("abcdef"): made(rng, depth - 1) for _ in range(rng.randrange(4))}
        return [made(rng, depth - 1) for _ in range(rng.randrange(3))]
    return rng.choice([None, True, False, 0, -7, 123456789012, "", "text", "é \" \\ \n", "1"])


def entries(frame, **options):
    found = {}
    for r in variants.flat_entries(frame, ["id"], "j", **options).collect():
        found.setdefault(r["id"], {})[r["key"]] = r["value"]
    return found


def test_rows_of_any_shape(spark):
    rng = random.Random(3)
    texts = [json.dumps({rng.choice("abcdef"): made(rng, 4) for _ in range(3)}, ensure_ascii=False) for _ in range(300)]
    texts += [None, "", "[1,2]", "7", "null", "{", "{}", '{"x":[]}', '{"x":[[1,[2]],[]]}', '{"a":{"b":{"c":{"d":{"e":{"f":1}}}}}}']
    frame = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "id int, j string, v string").repartition(3)
    want = {k: flat(t) for k, t in enumerate(texts)}
    assert entries(frame) == {k: x for k, x in want.items() if x}


def test_same_as_with_a_schema(spark):
    texts = [
        '{"id":"1","user":{"name":"n","home":{"region":"R"}},"tags":["a",null,"b"],"items":[{"product":"p","fee":3},{"product":"q"}]}',
        '{"id":"2","user":null,"items":[]}', '{"tags":["x"]}',
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    known = frame.select("id", F.explode(jsons.flat_json_entries("j", NESTED)).alias("e")).collect()
    want = {}
    for r in known:
        want.setdefault(r["id"], {})[r["e"]["key"]] = r["e"]["value"]
    assert entries(frame) == want


def test_keys_of_rows(spark):
    frame = spark.createDataFrame([("a", None, '{"k":1}'), ("a", 1, '{"k":2}')], "x string, y int, j string")
    got = variants.flat_entries(frame, ["x", "y"], "j")
    assert got.columns == ["x", "y", "key", "value"]
    assert sorted((r["x"], r["y"] or 0, r["value"]) for r in got.collect()) == [("a", 0, "1"), ("a", 1, "2")]
    assert variants.flat_entries(frame.limit(0), ["x"], "j").collect() == []
