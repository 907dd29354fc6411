from __future__ import annotations

import hashlib

import numpy as np
from test_jaccard import joined
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from scoreloom.functions.storage import settled
from scoreloom.llm.bpe import default_vocabulary
from scoreloom.llm.language import predicted_languages
from scoreloom.llm.mixing import mixed_sizes


def test_stages_against_plain_python(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = docs.collect()
    sure = {r["doc_id"] for r in predicted_languages(docs).collect() if r["score"] >= 0.5}
    wanted = [r for r in rows if any(c.isalpha() for c in r["text"] or "") and r["doc_id"] in sure]
    assert len(wanted) > 0.9 * len(rows)
    largest = {}
    for r in wanted:
        largest[r["text"]] = max(largest.get(r["text"], -1), r["doc_id"])
    wanted = [r for r in wanted if largest[r["text"]] == r["doc_id"]]
    near = {int(i) for i, _, c in joined([(r["doc_id"], r["text"]) for r in wanted], 5, 80) if i == c}
    frames = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = frames[name] = settled(stage(spark, current, data), name)
        assert current.columns == docs.columns
    ids = lambda name: sorted(r["doc_id"] for r in frames[name].collect())
    assert ids("exact") == sorted(r["doc_id"] for r in wanted)
    assert ids("near") == sorted(near)
    copies = {r["doc_id"]: r["copies"] for r in mixed_sizes(frames["near"]).collect()}
    assert ids("mix") == sorted(i for i, n in copies.items() for _ in range(n))
    tokenizer = Tokenizer.from_file(default_vocabulary())
    texts = {r["doc_id"]: r["text"] for r in wanted}
    result = corpus_pipeline.run(spark, data).collect()
    assert sorted(r["doc_id"] for r in result) == ids("mix")
    for r in result:
        encoded = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == encoded and r["n_tokens"] == len(encoded)
        assert r["ids_sha256"] == hashlib.sha256(np.array(encoded, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for number in range(1, 14):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
