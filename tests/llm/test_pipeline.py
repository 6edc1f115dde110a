"""The corpus pipeline: every stage against what it should keep, and the whole run against its stages."""

import pytest

import corpus_pipeline
from tests.conftest import rows
from tests.llm.conftest import FOLDER, ODD
from tests.llm.test_tables import plain_groups, plain_sets
from tidegauge.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(workers):
    """Results of all stages in order, each stored and read again."""
    docs = workers.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(workers, out[-1], FOLDER), f"test-{name}"))
    return out


def test_stages(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_jaccard_join", "mixture", "bpe"]
    assert all(df.columns == COLUMNS for df in staged[:-1])


def test_clean_documents_stay(workers, staged):
    everything, speaking, harmless = staged[:3]
    assert speaking.count() >= 0.99 * everything.count()
    labels = workers.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 0")
    clean = speaking.join(labels, "doc_id", "left_semi").count()
    assert harmless.join(labels, "doc_id", "left_semi").count() >= 0.97 * clean


def test_toxic_documents_go(workers, staged):
    labels = workers.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 1")
    before, after = ({r["lang"]: r["count"] for r in df.join(labels, "doc_id", "left_semi").groupBy("lang").count().collect()} for df in staged[1:3])
    assert before and all(after.get(lang, 0) <= 0.3 * n for lang, n in before.items())


def test_one_document_of_each_group_stays(staged):
    before = staged[2].select("doc_id", "text").orderBy("doc_id").collect()
    groups = plain_groups([r["doc_id"] for r in before], plain_sets([r["text"] for r in before]))
    want = sorted(i for i, n, group in groups if n == 0 or group == i)
    assert sorted(r["doc_id"] for r in staged[3].select("doc_id").collect()) == want


def test_sources_come_near_their_targets(staged):
    def words(df):
        out = {}
        for r in df.select("source", "text").collect():
            out.setdefault(r["source"], []).append(len(r["text"].split()))
        return out

    have, taken = words(staged[3]), words(staged[4])
    total, share = sum(map(sum, have.values())), [5, 2, 1]
    weights = {s: share[i % 3] for i, s in enumerate(sorted(have))}
    for source, sizes in have.items():
        # No source of this table reaches three times its size, so every target is its plain share.
        target = total * weights[source] / sum(weights.values())
        if target < 3 * sum(sizes):
            assert abs(sum(taken[source]) - target) <= max(sizes) + 0.02 * target


def test_run_equals_its_stages(workers, staged):
    assert rows(corpus_pipeline.run(workers, FOLDER)) == rows(staged[-1])


def test_odd_documents(workers, odd):
    docs = odd
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(workers, docs, FOLDER), f"odd-{name}")
        assert docs.columns == odd.columns
        left.append(docs.count())
    assert left[0] <= len(ODD) - 4  # null, empty, blank and letterless texts have no language
    assert corpus_pipeline.STAGES[-1][1](workers, docs, FOLDER).count() == left[-1]


def test_texts_under_a_null_id_and_under_one_id(workers):
    """Rows are told apart by id and text: only copies of a text go, never another text under the same id."""
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")
    data = [(None, a), (None, b), (None, b), (7, c), (7, d), (3, c), (8, a), (9, None), (9, "")]
    docs = workers.createDataFrame([(i, t, "en", "s", 0) for i, t in data], ", ".join(f"{n} {t}" for n, t in zip(COLUMNS, ["long", "string", "string", "string", "int"])))
    kept = stored(corpus_pipeline.drop_near_duplicates(workers, docs, FOLDER), "test-one-id")
    assert rows(kept.select("doc_id", "text")) == sorted([(None, b), (7, d), (3, c), (8, a), (9, None), (9, "")], key=repr)
    mixed = corpus_pipeline.mix_sources(workers, kept, FOLDER)
    assert rows(mixed.select("doc_id", "text")) == sorted([(None, b), (7, d), (3, c), (8, a)], key=repr)


@pytest.mark.parametrize("marks", [[], [(99, 1, 0), (98, 0, 1)], [(1, 1, None), (2, 1, None)], [(1, 1, 1), (2, 0, 1)], [(1, 1, 0)]])
def test_without_labels_of_both_kinds_all_stay(workers, tmp_path, marks):
    workers.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    data = [(1, "a clean text"), (2, "another one"), (3, "and a third"), (None, ""), (4, None)]
    docs = workers.createDataFrame([(i, t, "en", "s", 0) for i, t in data], "doc_id long, text string, lang string, source string, n_chars int")
    assert rows(corpus_pipeline.drop_toxic(workers, docs, str(tmp_path))) == rows(docs)


def test_empty_documents(workers, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(workers, docs, FOLDER)
        assert docs.count() == 0
