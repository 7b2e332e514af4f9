"""The pipeline, stage by stage, against the operators' plain versions."""

import sys
from collections import Counter, defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as cp  # noqa: E402
import public_tokenizers as P  # noqa: E402
from odd import documents  # noqa: E402
from test_apportion import check, words  # noqa: E402
from test_bytebpe import RANKS  # noqa: E402
from test_mcd import brute_counts, failed  # noqa: E402
from test_simhash import brute as brute_groups  # noqa: E402

from finwater.llm import bytebpe, langid, mcd  # noqa: E402

SF = "/root/testdata/sf0.001"


def stage(spark, name, docs, tmp_path):
    out = dict(cp.STAGES)[name](spark, docs, SF)
    path = str(tmp_path / name)
    out.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda df: [tuple(r) for r in df.collect()]
    text = {r[0]: r[1] for r in rows(docs)}

    told = stage(spark, "language_id", docs, tmp_path)
    want = {r["doc_id"] for r in langid.predict(docs, langid.fit(docs), keep=["doc_id"]).filter("NOT rejected").collect()}
    assert told.columns == docs.columns and {r[0] for r in rows(told)} == want and len(want) > 0.97 * len(text)

    good = stage(spark, "quality_rules", told, tmp_path)
    kept = {r[0] for r in rows(good)}
    assert good.columns == docs.columns
    assert kept == {r["doc_id"] for r in mcd.judge(told).filter("kept").collect()}
    assert kept <= {i for i in want if not failed(brute_counts(text[i]))}

    once = stage(spark, "simhash_dedup", good, tmp_path)
    assert once.columns == docs.columns
    assert sorted(rows(once)) == sorted(r for r in rows(good) if r[0] in {i for i, _, c in brute_groups([(r[0], r[1]) for r in rows(good)]) if i == c})

    mixed = stage(spark, "mix_sources", once, tmp_path)
    assert mixed.columns == docs.columns
    given, taken, own = defaultdict(int), Counter(), {r[0]: r for r in rows(once)}
    for r in rows(mixed):
        assert r[2:4] == own[r[0]][2:4]
        taken[r[0]] += len(words(r[1]))
    per = defaultdict(int)
    for r in own.values():
        per[r[3]] += len(words(r[1]))
    order = sorted(per)
    from finwater.llm import apportion

    target = dict(zip(order, apportion.targets([per[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    check([(i, len(words(r[1])), per[r[3]], target[r[3]], taken[i]) for i, r in own.items()], [r[3] for r in own.values()])

    last = stage(spark, "byte_bpe", mixed, tmp_path)
    coder = bytebpe.ByteBPE(bytebpe.read_ranks(RANKS), P.PATTERN)
    sizes = Counter((r[0], len(coder.encode([r[1]])[0])) for r in rows(mixed))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in last.collect()) == sizes


def test_run_equals_the_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, _ in cp.STAGES:
        docs = stage(spark, name, docs, tmp_path)
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_odd_and_empty_documents(spark, tmp_path):
    for k, docs in enumerate((documents(spark), documents(spark).limit(0))):
        columns = docs.columns
        for name, _ in cp.STAGES:
            assert docs.columns == columns
            docs = stage(spark, name, docs, tmp_path / str(k))
        assert (docs.count() > 0) == (k == 0)
