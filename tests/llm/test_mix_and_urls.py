from __future__ import annotations

import re
from math import floor

import corpus_pipeline
from odd import ODD

from wardmill.llm import mix, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_rounds(sizes: dict, weights, share, most) -> dict:
    """Targets by resharing the excess again and again."""
    total = share * sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: dict = {}
    while True:
        left = total - sum(full.values())
        live = [s for s in order if s not in full]
        target = {s: left * weight[s] / sum(weight[x] for x in live) for s in live}
        above = [s for s in live if target[s] > most * sizes[s]]
        if not above:
            return full | target
        full |= {s: most * sizes[s] for s in above}


def test_mix_meets_its_targets(documents):
    texts = [" ".join(["w"] * (1 + i * 7 % 23)) for i in range(200)] + ODD
    rows = mix.mix(documents(texts)).collect()
    sizes: dict = {}
    for i, t in enumerate(texts):
        source = f"s{i % 3}" if i % 7 else None
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(t or ""))
    expected = by_rounds(sizes, mix.WEIGHTS, mix.SHARE, mix.MOST)
    taken: dict = {}
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id] or ""))
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: floor(expected[s] + 1e-9) for s in expected}
    assert len(rows) == len(texts)


def test_mixed_texts_hold_the_words_taken(documents):
    docs = documents([" ".join(f"w{j}" for j in range(1 + i % 5)) for i in range(40)])
    plan = mix.mix(docs).persist()
    found: dict = {}
    for r in mix.mixed_texts(docs, plan).collect():
        found[r.row.doc_id] = found.get(r.row.doc_id, 0) + len(r.body.split())
    assert found == {r.doc_id: r.taken for r in plan.collect() if r.taken}


def test_the_last_stage_gives_the_mixed_texts(spark, documents):
    """Whole copies, the part at the cut, and nothing twice for repeated rows."""
    texts = [" ".join(f"w{j}" for j in range(1 + i % 5)) for i in range(40)]
    docs = documents([*enumerate(texts), *[(7, texts[7])] * 5, (None, "a\tb c"), (50, None)])
    rows = corpus_pipeline.mixed(spark, docs, "").collect()
    assert len(rows) == 47 and any(r.taken % r.size for r in rows if r.size)
    for r in rows:
        body = {None: "a\tb c", 50: ""}.get(r.doc_id) if r.doc_id in (None, 50) else texts[r.doc_id]
        copies, rest = divmod(r.taken, r.size) if r.size else (0, 0)
        assert r.texts == [body] * copies + [" ".join(body.split()[:rest])] * (rest > 0)


def test_the_given_texts_are_moved_once(spark, documents):
    docs = documents(["a b", "c d e"])
    plan = mix.mix(docs).localCheckpoint()
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = mix.given(docs, plan)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert shown.count("Exchange hashpartitioning") == 2  # the texts and the plan


def test_given_texts_of_documents_without_id(spark):
    shape = "doc_id long, text string, source string"
    docs = spark.createDataFrame([(None, "a b", "x"), (0, "a b", "x"), (1, None, "x")], shape)
    rows = mix.given(docs, mix.mix(docs).localCheckpoint()).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in rows) == [-1, 0, 1]
    for r in rows:
        assert sum(len(text.split()) for text in r.texts) == r.taken


def test_mix_of_nothing_and_of_repeated_rows(documents, spark):
    assert mix.mix(documents(["a"]).limit(0)).count() == 0
    twice = documents([(1, "a b c")] * 3 + [(None, "d e"), (None, None)])
    rows = mix.mix(twice).collect()
    targets = {r.source: r.target for r in rows}
    assert len(rows) == 5 and sum(r.taken for r in rows) == sum(map(floor, targets.values()))
    assert mix.mix(documents([None, ""])).count() == 2


RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def longest(host: str, path: str, rules):
    fits = []
    for verdict, text in rules:
        name, slash, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            fits.append((name.count("."), len(slash + rest), verdict == "block", verdict, text))
    return max(fits)[3:] if fits else None


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "https://A.Example.NET/en/1?x=/de/",
    "http://example.com/de/", "http://badexample.com/de/x", "http://x.org/fr", "http://x.org/fr/#a",
    "ftp://u@x.net:80/en/", "http://a.net?b/c", "http://É.net/", "http://x.org/FR/", "a://b://c.net/d",
    "http://x.example.net/en", "http://net./x", "http://..net/x", "http://" + "a." * 9000 + "net/" + "p/" * 9000,
]


def test_url_verdicts(spark):
    for r in url_filter.verdicts(pages(spark, URLS), RULES).collect():
        url = URLS[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        hit = longest(host, path, RULES)
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == ((hit[1], hit[0]) if hit else (None, "allow"))


def test_tries_in_parts_agree_with_one(spark, monkeypatch):
    rules = [
        (v, h + p)
        for v, h in zip(["allow", "block"] * 4, ["net", "a.net", "b.a.net", "c.net", "org", "x.org", "net", "com"], strict=True)
        for p in ("/", "/e", "/en/", "/en/x")
    ]
    urls = [f"http://{h}{p}" for h in ("net", "z.net", "a.net", "b.a.net", "q.b.a.net", "x.org", "com") for p in ("", "/", "/en", "/en/", "/en/xyz", "/e/n")]
    whole = url_filter.verdicts(pages(spark, urls), rules, "block").collect()
    for r in whole:
        hit = longest(r.host, r.path, rules)
        assert (r.rule, r.verdict) == ((hit[1], hit[0]) if hit else (None, "block"))
    monkeypatch.setattr(url_filter, "TRIE_RULES", 5)
    assert url_filter.verdicts(pages(spark, urls), rules, "block").collect() == whole
    assert url_filter.verdicts(pages(spark, urls).limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.verdicts(pages(spark, urls), ()).collect()} == {"allow"}
