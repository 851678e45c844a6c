import random
import re

from strata.llm.line_dedup import CLAUSES, LINES, PARAGRAPHS, drop_repeated_units, repeated_units, without
from tests.llm.support import documents, no_documents, odd_documents, odd_rows, prose, words_of


def brute_force(given, min_words=30, separator=CLAUSES):
    """(doc_id, unit, start, end, words, keep_id, keep_unit, words of the run) by a walk over all
    units in order."""
    order = sorted(range(len(given)), key=lambda i: (given[i][0] is None, given[i][0] or 0, i))
    units = {}
    for i in order:
        at, mine, text = 0, [], given[i][1] or ""
        for piece in re.split(f"({separator})", text):
            if not re.fullmatch(separator.replace("(?<=[.!?,;:])", ""), piece):
                words = words_of(piece)
                if words:
                    mine.append((" ".join(words), at, at + len(piece), len(words)))
            at += len(piece)
        units[i] = mine
    first = {}
    for i in order:
        for u, (key, *_) in enumerate(units[i]):
            first.setdefault(key, (i, u))
    out = []
    for i in order:
        later = [u for u, (key, *_) in enumerate(units[i]) if first[key] != (i, u)]
        runs = []
        for u in later:
            if runs and runs[-1][-1] == u - 1:
                runs[-1].append(u)
            else:
                runs.append([u])
        for run in runs:
            total = sum(units[i][u][3] for u in run)
            if total >= min_words:
                for u in run:
                    key, a, b, n = units[i][u]
                    j, v = first[key]
                    out.append((given[i][0], u, a, b, n, given[j][0], v, total))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def lines(seed, n=60):
    rng = random.Random(seed)
    pool = [prose(rng.randrange(12), rng.choice([1, 3, 20, 55])) for _ in range(25)]
    ends = ["\n", "\n\n", ". ", ", ", " ", ".\n", "!  \t", "; \n", "."]
    return [
        (i, "".join(rng.choice(pool) + rng.choice(ends) for _ in range(rng.randrange(9)))) for i in range(n)
    ]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        for separator in (CLAUSES, LINES):
            for least in (1, 30):
                found = result(repeated_units(documents(spark, lines(seed)), separator, least))
                assert found == brute_force(lines(seed), least, separator)


def test_a_passage_within_lines_of_many_documents(spark):
    passage = ", ".join(prose(k, 11, 10**6) for k in range(7)) + "."
    given = [
        (i, f"{prose(100 + i, 9, 10**6)} {prose(300 + i, 8, 10**6)}. {passage} {prose(200 + i, 9, 10**6)}.") for i in range(80)
    ]
    found = result(repeated_units(documents(spark, given)))
    assert found == brute_force(given) and {(r[0], r[7]) for r in found} == {(i, 77) for i in range(1, 80)}


def test_what_separated_a_unit_goes_with_it():
    text = "one. two, three\nfour\nfive. six"
    at = lambda *words: [(text.index(w), text.index(w) + len(w)) for w in words]
    assert without(text, at("one.")) == "two, three\nfour\nfive. six"
    assert without(text, at("two,")) == "one. three\nfour\nfive. six"
    assert without(text, at("three")) == "one. two, \nfour\nfive. six"
    assert without(text, at("four")) == "one. two, three\nfive. six"
    assert without(text, at("one.", "two,", "three")) == "four\nfive. six"
    assert without(text, at("four", "five.")) == "one. two, three\nsix"
    assert without(text, at("six", "five.")) == "one. two, three\nfour\n"


def test_a_line_that_all_share(spark):
    shared = prose(5, 60)
    given = [(i, f"{prose(100 + i, 5)}\n  {shared.upper()}\t\n{prose(200 + i, 5)}") for i in range(500)]
    found = result(repeated_units(documents(spark, given)))
    assert found == brute_force(given)
    assert [r[5] for r in found if r[4] == 60] == [0] * 499


def test_awkward_rows(spark):
    found = result(repeated_units(odd_documents(spark)))
    # Repeated rows are told apart by their place in the table, which has no fixed order.
    assert [r[:5] for r in found] == [r[:5] for r in brute_force(odd_rows())]
    assert result(repeated_units(no_documents(spark))) == []
    assert result(repeated_units(no_documents(spark), PARAGRAPHS)) == []
    found = result(repeated_units(odd_documents(spark), PARAGRAPHS))
    assert [r[:5] for r in found] == [r[:5] for r in brute_force(odd_rows(), separator=PARAGRAPHS)]


def test_units_are_cut_out(spark):
    shared = prose(5, 60)
    given = [(1, f"keep\n{shared}"), (2, f"a\n{shared}\nb"), (3, shared), (4, "keep"), (5, None), (6, f"{shared}\nz")]
    cut = drop_repeated_units(documents(spark, given))
    assert {r.doc_id: r.text for r in cut.collect()} == {1: given[0][1], 2: "a\nb", 3: "", 4: "keep", 5: None, 6: "z"}
    spans = {r.doc_id: r.removed_spans for r in cut.collect()}
    assert spans[2][0] == (2, 2 + len(shared)) and spans[4] is None
    assert set(cut.columns) == {*documents(spark, []).columns, "removed_spans"}
    assert drop_repeated_units(no_documents(spark)).collect() == []


def test_paragraphs(spark):
    block = prose(1, 30) + "\n" + prose(2, 30)
    given = [(1, f"{block}\n \n{prose(3, 60)}"), (2, f"{prose(4, 5)}\n\n{block}")]
    found = result(repeated_units(documents(spark, given), separator=PARAGRAPHS))
    assert [(r[0], r[4], r[5]) for r in found] == [(2, 60, 1)]
