"""The pipeline against a plain version of its stages."""

import re

import corpus_pipeline
from lexmill.llm.quality import quality

SF = "/root/testdata/sf0.01"


def test_pipeline_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = sorted(r["doc_id"] for r in quality(docs).where("kept").collect())
    sets = {}
    for k in left:
        w = re.findall(rb"[^\x20\x09-\x0D]+", texts[k].encode().lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    root = {k: k for k in left}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k in left:
        for g in sets[k]:
            holders.setdefault(g, []).append(k)
    pairs = {(a, b) for ids in holders.values() for i, b in enumerate(ids) for a in ids[:i]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    left = [k for k in left if top(k) == k]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [k for k in left if not any(t.lower() in texts[k].lower() for t in items)]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == left
    assert len({r["mix_position"] for r in out}) == len(out)
    secret = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8,}|[0-9a-f]{32,}", re.I)
    for r in out:
        assert not secret.search(r["text"]) and r["n_chars"] == len(r["text"])
        if "[SECRET]" not in r["text"]:
            assert r["text"] == texts[r["doc_id"]]
