import re

import corpus_pipeline
from strata.llm.shared import stored
from tests.llm import test_decontaminate, test_mixing, test_near_dedup
from tests.llm.support import documents, no_documents, odd_documents, prose


def corpus():
    """Documents with something for every stage to do, in two made-up languages."""

    def text(seed, n, lang):
        return " ".join({"aa": "ba", "bb": "ku"}[lang] + w.replace("w", "xyz"[seed % 3]) for w in prose(seed, n, 10**6).split())

    given = []
    for i in range(120):
        lang = "aa" if i % 3 else "bb"
        given.append((i, text(i, 60, lang), lang, f"src{i % 4}"))
    given += [(200 + i, f"  {given[i][1]}".replace(" ", "\n", 3), given[i][2], "src1") for i in range(10)]
    given += [(300 + i, test_near_dedup.edited(text(i, 60, "aa" if i % 3 else "bb"), 1, i), given[i][2], "src2") for i in range(20, 30)]
    given += [(400, "12345 ...", "aa", "src0"), (401, None, "bb", None), (402, "", "aa", "src0")]
    given += [(500 + i, text(1000 + i, 30, "aa") + " " + BENCH, "aa", "src3") for i in range(5)]
    return given


BENCH = "one two three four five six seven eight nine ten eleven"


def save(spark, folder, given):
    docs = documents(spark, given).select("doc_id", "text", "lang", "source", "n_chars")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_works_on_what_the_one_before_kept(spark, folder):
    given = corpus()
    save(spark, folder, given)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        columns = docs.columns
        docs = stored(stage(spark, docs, folder))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language":
            assert kept[name] == {d for d, t, *_ in given if t and re.search(r"[^\W\d_]", t)}
        elif name == "exact":
            firsts = {}
            for d, t in sorted(before):
                firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), d)
            assert kept[name] == set(firsts.values())
        elif name == "near":
            brute = test_near_dedup.brute_force(before, 5)
            assert kept[name] == {d for d, _, c in brute if d == c} and len(kept[name]) < len(before)
        elif name == "benchmark":
            dirty = {r[0] for r in test_decontaminate.brute_force(before, [(1, BENCH)]) if r[-1]}
            assert dirty and kept[name] == {d for d, _ in before} - dirty
        if name != "mix":
            assert docs.columns == columns and len(kept[name]) == docs.count()
        else:
            rows = [r for r in given if r[0] in {d for d, _ in before}]
            sizes = test_mixing.source_sizes(rows)
            targets = test_mixing.plain_targets(sizes)
            taken = {}
            for r in docs.collect():
                taken[r.source] = taken.get(r.source, 0) + len(test_mixing.WORDS.findall(r.text))
            assert all(abs(taken.get(s, 0) - targets[s]) <= 70 for s in targets)


def test_run_is_the_stages_in_a_row(spark, folder):
    save(spark, folder, corpus())
    once = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.run(spark, folder)
    assert once.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_awkward_rows_and_empty_tables_go_through(spark, folder):
    for number, docs in enumerate((odd_documents(spark), no_documents(spark))):
        place = f"{folder}/{number}"
        save(spark, place, [])
        for _, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, place))
            assert docs.columns[: len(columns)] == columns
        assert (docs.count() > 0) == (number == 0)


def test_documents_stay_where_no_language_is_known(spark, folder):
    docs = documents(spark, [(1, "some words", None), (2, "12 ...", None), (3, None, None), (4, "中", None)])
    kept = corpus_pipeline.keep_known_languages(spark, docs, folder)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4] and kept.columns == docs.columns
