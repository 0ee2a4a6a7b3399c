import re

import pytest

from fixtures import as_rows
from tallywell.llm import ngram_jaccard
from tallywell.llm.components import components


def sets_of(rows):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        out.append(frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    name = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            name[find(i)] = min(name.get(find(i), d), d)
    return sorted(((d, len(sets[i]), name.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("settings", [ngram_jaccard.Settings(), ngram_jaccard.Settings(few=2, most=2, min_hashes=1, verify=1)])
def test_against_brute_force(docs, rows, settings):
    assert as_rows(ngram_jaccard.link(docs, settings), "doc_id", "n_shingles", "component_id") == brute(rows)


def test_one_of_each_group_stays(docs, rows):
    kept = ngram_jaccard.deduplicate(docs)
    assert kept.columns == docs.columns
    want = {c for _, n, c in brute(rows) if n}
    blank = sum(n == 0 for _, n, _ in brute(rows))
    got = kept.collect()
    # Id 15 names two groups.
    assert len(got) == len(want) + 1 + blank and {r.doc_id for r in got if r.text and r.text.split()} == want


def test_empty_table(nothing):
    assert ngram_jaccard.link(nothing).count() == 0 and ngram_jaccard.deduplicate(nothing).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 150)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 200: 150, 150: 150}
