import random

from pyspark.sql import functions as F

from orderflow.llm import host_rank as hr
from orderflow.llm.common import table

SCHEMA = "page_id long, url string, html string, host string, score int"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:at], rest[at:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fits = [(h + p, v) for h, p, v in hr.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def brute_scores(pages, turns=hr.TURNS):
    """Trust and distrust by plain loops."""
    hosts, links = {}, {}
    for url, found in pages:
        h, p = split(url)
        if not h:
            continue
        entry = hosts.setdefault(h, [0, 0, 0])
        entry[0] += 1
        v = rule(h, p)[1]
        entry[1] += v == "allow"
        entry[2] += v == "block"
        for to in found:
            links[h, to or h] = links.get((h, to or h), 0) + 1
    for h in hosts:
        up = h.split(".", 1)[-1]
        if up != h and up in hosts:
            links[h, up] = links.get((h, up), 0) + 1
    ranks = []
    for k, edges in ((1, links), (2, {(b, a): n for (a, b), n in links.items()})):
        total = sum(e[k] for e in hosts.values())
        seed = {h: e[k] / total for h, e in hosts.items() if e[k]} if total else {}
        out, rank = {}, dict(seed)
        for (a, _), n in edges.items():
            out[a] = out.get(a, 0) + n
        for _ in range(turns):
            new = {}
            for (a, b), n in edges.items():
                if a in rank:
                    new[b] = new.get(b, 0) + hr.DAMPING * rank[a] * n / out[a]
            home = 1 - sum(new.values())
            for h, m in seed.items():
                new[h] = new.get(h, 0) + m * home
            rank = new
        ranks.append(rank)
    n = sum(e[0] for e in hosts.values())
    trust, distrust = ranks
    return {h: (trust.get(h, 0) - distrust.get(h, 0)) / (trust.get(h, 0) + distrust.get(h, 0) + e[0] / n) for h, e in hosts.items()}


def test_rules_and_ranks(spark):
    rng = random.Random(3)
    names = [f"h{k}.example.{t}" for k in range(6) for t in ("com", "net", "org")] + ["a.h1.example.org", "B.h1.example.org", "good.io"]
    pages = []
    for _ in range(300):
        url = "https://" + rng.choice(names) + rng.choice(["", "/", "/en/x", "/de/y?z#k", "/fr/", "?/fr/", "#/en/"])
        pages.append((url, [rng.choice([*names, ""]).lower() for _ in range(rng.randrange(3))]))
    pages += [(None, ["good.io"]), ("no scheme", []), ("", []), ("x://", []), ("http://Net/", []), ("http://bnet/", []), pages[0]]
    rows = []
    for k, (url, to) in enumerate(pages):
        body = "".join(f'<a HREF="{"https://" + t + "/p" if t else "/own"}">' if k % 2 else f"<img src = '//{t}?q'>" if t else "<a href=own>" for t in to)
        rows.append((k, url, body + "<a href='mailto:x@y.z'>", "clash", 1))
    rows.append((None, "http://good.io/", None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute_scores([*pages, ("http://good.io/", [])])
    got = {r["host"]: r["score"] for r in hr.host_scores(docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)
    verdicts = hr.url_verdicts(docs, limit=0.2).collect()
    assert len(verdicts) == len(rows)
    urls = {r[0]: r[1] for r in rows}
    for r in verdicts:
        host, path = split(urls[r["page_id"]])
        text, says = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, text)
        assert r["verdict"] == (says or ("block" if want.get(host, 0) < -0.2 else "allow"))
    assert {"block"} <= {r["verdict"] for r in verdicts if r["rule"] is None}
    assert hr.url_verdicts(docs.limit(0)).collect() == []


def test_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    rows = hr.url_verdicts(pages).collect()
    assert len(rows) == pages.count()
    urls = {r["page_id"]: r["url"] for r in pages.select("page_id", F.col("url")).collect()}
    for r in rows:
        host, path = split(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule(host, path)[0])
