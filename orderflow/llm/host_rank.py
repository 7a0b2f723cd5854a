"""URL filter: rules, and trust and distrust spread over the links between hosts.

A rule blocks or allows a host with its subdomains under a path; the longest rule that fits decides. Pages
that no rule fits are judged by their host: personalised PageRank starts from hosts with allowed pages and
follows links; distrust starts from hosts with blocked pages and follows links backwards. Both are compared
with the host's share of all pages, and hosts whose distrust prevails by LIMIT are blocked.

Links are taken from href and src attributes; those without a host stay on their own, and a subdomain links
to the host above it where that has pages. The link table is summed per pair of hosts before it is used.

Defined results: a null url or one without "://" has an empty host and path, fits no rule and is allowed; a
null page body has no links; without rules or pages nothing is blocked; repeated rows are judged each; only
id, url and body are read.
"""

from pyspark.sql import functions as F

from orderflow.llm.common import ascii_lower, written

# Host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DAMPING = 0.85
TURNS = 12
CUT_EVERY = 2
LIMIT = 0.5
LINKS = r"""(?i)\b(?:href|src)\s*=\s*["']?([^"'\s>]+)"""


def host_and_path(url):
    """Columns for the host in lower case and the path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def rule_of(host, path, rules=RULES):
    """Columns for the longest rule that fits, and its verdict; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def host_links(pages, hosts, url="url", body="html"):
    """Links between hosts, with how many there are: src, dst, n."""
    own, _ = host_and_path(F.col(url))
    link = F.explode(F.regexp_extract_all(F.coalesce(F.col(body), F.lit("")), F.lit(LINKS), 1)).alias("link")
    rows = pages.select(own.alias("src"), link).where("src <> ''")
    full = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    there, _ = host_and_path(full)
    other_scheme = F.regexp_like("link", F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")) & ~F.contains("link", F.lit("://"))
    rows = rows.where(~other_scheme).select("src", F.when(there == "", F.col("src")).otherwise(there).alias("dst"))
    up = hosts.select(F.col("host").alias("src"), F.regexp_replace("host", r"^[^.]*\.", "").alias("dst"))
    known = hosts.select(F.col("host").alias("h"))
    up = up.where("src <> dst").join(known, F.col("dst") == F.col("h"), "left_semi")
    return rows.unionByName(up).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def spread(links, seeds, damping=DAMPING, turns=TURNS):
    """Personalised PageRank of each kind: kind, host, rank. `links` have kind, src, dst, n and `seeds` kind,
    host, mass, which sum to 1 in a kind. What hosts without links hold goes back to the seeds."""
    out = links.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    links = written(links.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("part")), "links")
    ranks = seeds.select("kind", "host", F.col("mass").alias("rank"))
    for turn in range(turns):
        held = ranks.select("kind", F.col("host").alias("src"), "rank")
        sent = links.join(held, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("part") * F.col("rank") * damping).alias("rank"))
        given = sent.groupBy("kind").agg(F.sum("rank").alias("given"))  # a row per kind
        home = seeds.join(F.broadcast(given), "kind", "left").select(
            "kind", "host", (F.col("mass") * (1 - F.coalesce("given", F.lit(0.0)))).alias("rank")
        )
        ranks = sent.unionByName(home).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if turn % CUT_EVERY == CUT_EVERY - 1:
            ranks = written(ranks, "ranks")
    return ranks


def host_scores(pages, url="url", body="html", rules=RULES, **options):
    """Per host with pages: trust, distrust and score, from -1 to 1."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(host.alias("host"), path.alias("path")).where("host <> ''")
    _, verdict = rule_of(F.col("host"), F.col("path"), rules)
    hosts = rows.groupBy("host").agg(
        F.count("host").alias("pages"), F.count_if(verdict == "allow").alias("allow"),
        F.count_if(verdict == "block").alias("block"),
    )
    hosts = written(hosts, "hosts")
    totals = hosts.agg(*[F.sum(c).alias(c) for c in ("pages", "allow", "block")]).first()
    links = written(host_links(pages, hosts, url, body), "links")
    both = links.select(F.lit("allow").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    seeds = None
    for kind in ("allow", "block"):
        mass = (F.col(kind) / F.lit(float(totals[kind] or 1))).alias("mass")
        part = hosts.where(F.col(kind) > 0).select(F.lit(kind).alias("kind"), "host", mass)
        seeds = part if seeds is None else seeds.unionByName(part)
    ranks = spread(both, seeds, **options)
    ranks = ranks.groupBy(F.col("host").alias("h")).agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("rank"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "block", F.col("rank"))).alias("distrust"),
    )
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    share = F.col("pages") / F.lit(float(totals["pages"] or 1))
    return hosts.join(ranks, F.col("host") == F.col("h"), "left").select(
        "host", trust.alias("trust"), distrust.alias("distrust"),
        ((trust - distrust) / (trust + distrust + share)).alias("score"),
    )


def url_verdicts(pages, id="page_id", url="url", body="html", rules=RULES, limit=LIMIT, **options):
    """Per row: host, path, the rule that fits, and the verdict of the rule or of the host."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("says"))
    scores = host_scores(pages, url, body, rules, **options).select(F.col("host").alias("h"), "score")
    judged = F.when(F.col("score") < -limit, "block").otherwise("allow")
    return rows.join(scores, F.col("host") == F.col("h"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("says", judged).alias("verdict")
    )
