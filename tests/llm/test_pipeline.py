import hashlib
import re
from collections import Counter
from pathlib import Path

import public_tokenizers
import sentencepiece

import corpus_pipeline
from graphloom.llm import langid, pii, simhash
from graphloom.llm.session import checkpoint_folder

from test_mixing import plain_targets


def test_stages_against_plain_versions(spark):
    """Each stage on the rows its predecessor kept, compared with a version that looks at all rows or pairs."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]

    model = langid.fit_documents(docs)
    _, _, rejected = langid.predict(model, [r["text"] for r in rows])
    rows = [r for r, out in zip(rows, rejected) if not out]
    docs = corpus_pipeline.identify_language(spark, docs, sf_dir)
    same(docs, rows)

    prints = [simhash.fingerprint(r["text"]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r["doc_id"]), r["doc_id"])
    rows = [r for r in rows if r["doc_id"] in least.values()]
    docs = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    same(docs, rows)

    for r in rows:
        r["text"] = pii.redacted(r["text"])
        r["n_chars"] = len(r["text"])
    docs = corpus_pipeline.redact_personal_data(spark, docs, sf_dir)
    same(docs, rows)

    mixed = corpus_pipeline.mix_sources(spark, docs, sf_dir).cache()
    times = Counter(r.doc_id for r in mixed.collect())
    by_id = {r["doc_id"]: r for r in rows}
    assert all(tuple(r) == tuple(by_id[r.doc_id].values()) for r in mixed.collect())
    assert times == plain_times(rows)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = corpus_pipeline.encode(spark, mixed, sf_dir).collect()
    wanted = []
    for r in mixed.collect():
        ids = library.encode(r.text)
        joined = ",".join(map(str, ids))
        wanted.append((r.doc_id, r.source, len(ids), joined, hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(wanted)


def plain_times(rows):
    """How often each document is taken: whole uses of its source, and once more where the rest takes half of it or more."""
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    names, times = sorted({r["source"] for r in rows}), Counter()
    targets = plain_targets([sum(size(r) for r in rows if r["source"] == s) for s in names])
    for name, target in zip(names, targets):
        own = sorted((r for r in rows if r["source"] == name), key=lambda r: int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:15], 16))
        uses, rest = divmod(int(target), sum(map(size, own)))
        for r in own:
            times[r["doc_id"]] += (uses + (2 * min(max(rest, 0), size(r)) >= size(r))) if size(r) else 0
            rest -= size(r)
    return +times


def same(docs, rows):
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"]) == sorted(rows, key=lambda r: r["doc_id"])


def test_run_equals_its_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_small_tables_make_few_checkpoint_files(spark):
    """However many shuffle partitions there are: on a local folder, each file costs processes that executors start."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(2)
    folder = Path(checkpoint_folder(spark).removeprefix("file:"))
    given = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in given}
    stages = (corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources)
    wanted = [sorted(stage(spark, docs, "").collect()) for stage in stages]
    try:
        for k, v in given.items():
            spark.conf.set(k, v)
        for stage, rows in zip(stages, wanted):
            old = set(folder.glob("rdd-*"))
            assert sorted(stage(spark, docs, "").collect()) == rows
            files = [len(list(made.glob("part-*"))) for made in set(folder.glob("rdd-*")) - old]
            assert files and max(files) <= 2  # as the documents come
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
