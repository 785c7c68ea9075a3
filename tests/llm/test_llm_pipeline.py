"""The corpus pipeline on the smallest tables, stage by stage, against brute force."""

from __future__ import annotations

import collections
import itertools
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lodestat.llm import neardedup
from lodestat.session import cut

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    """Rows after each stage, the input first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut(stage(spark, out[-1], SF)))
    return [(d.columns, d.collect()) for d in out]


def _texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_columns_stay_until_packing(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "mix", "pack"]
    assert all(columns == steps[0][0] for columns, _ in steps[:-1])


def test_language_keeps_whole_clean_documents(steps):
    before, after = _texts(steps[0][1]), _texts(steps[1][1])
    assert set(after) <= set(before) and all(after[k] == before[k] for k in after)
    assert len(after) >= 0.95 * len(before)
    assert all(re.search(r"[^\W\d_]", t) for t in after.values())


def test_lines_lose_only_what_an_earlier_document_holds(steps):
    before, after = _texts(steps[1][1]), _texts(steps[2][1])
    assert set(before) == set(after)
    held = {line for t in after.values() for line in t.split("\n")}
    cut_lines = 0
    for k in before:
        old, new = before[k].split("\n"), after[k].split("\n") if after[k] else []
        rest = iter(old)
        assert all(line in rest for line in new)  # in order
        gone = collections.Counter(old) - collections.Counter(new)
        cut_lines += sum(gone.values())
        assert set(gone) <= held
    assert cut_lines > 0
    long = collections.Counter(line for t in after.values() for line in t.split("\n") if len(WORD.findall(line)) >= 50)
    assert max(long.values(), default=1) == 1


def test_one_document_of_each_near_group_stays(steps):
    before, after = _texts(steps[2][1]), _texts(steps[3][1])
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for k, t in before.items():
        w = WORD.findall(t.translate(lower))
        if w:
            sets[k] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    parent = {k: k for k in before}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert after == {k: t for k, t in before.items() if find(k) == k}


def test_near_copies_go_from_080(spark):
    def words(own, n):
        return " ".join([f"w{j}" for j in range(100)] + [f"{own}{j}" for j in range(n)])

    # 96 shared shingles each: 96 of 118 (0.81) are near copies, 96 of 124 (0.77) are not
    rows = [(0, words("a", 11)), (1, words("b", 11)), (2, words("c", 17))]
    assert [(round(len(x & y) / len(x | y), 2)) for x, y in itertools.combinations([frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in (t.split() for _, t in rows)], 2)] == [0.81, 0.77, 0.77]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, frame, SF).collect()) == [0, 2]
    assert neardedup.band_rows((85, 100)) == 5 and neardedup.band_rows((80, 100)) == 4


def test_near_stage_agrees_with_brute_force_at_080(steps):
    before, after = _texts(steps[2][1]), _texts(steps[3][1])
    sets = {k: s for k, t in before.items() if len(s := neardedup.shingles(t))}
    parent = {k: k for k in before}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if neardedup.linked(sets[a], sets[b], (80, 100)):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert after == {k: t for k, t in before.items() if find(k) == k}


def test_mix_repeats_whole_documents_near_targets(steps):
    before, after = steps[3][1], steps[4][1]
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in before}
    times = collections.Counter(r["doc_id"] for r in after)
    assert max(times.values()) <= 3 and {r["doc_id"]: r["text"] for r in after} == {k: t for k, t in _texts(before).items() if times[k]}
    source = {r["doc_id"]: r["source"] for r in before}
    own = collections.Counter()
    for k, n in size.items():
        own[source[k]] += n
    names = sorted(own)
    weight, rest, free, goal = {n: 1 + i % 3 for i, n in enumerate(names)}, sum(own.values()), set(names), {}
    while free:
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > 3 * own[n]]
        goal.update(share if not over else {n: 3 * own[n] for n in over})
        rest -= sum(3 * own[n] for n in over)
        free -= set(over) if over else free
    taken = collections.Counter()
    for k, n in times.items():
        taken[source[k]] += n * size[k]
    longest = collections.Counter()
    for k, n in size.items():
        longest[source[k]] = max(longest[source[k]], n)
    assert all(abs(taken[n] - goal[n]) <= longest[n] / 2 + 1 for n in names)


def test_packing_holds_the_mix(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = collections.Counter()
    for r in steps[4][1]:
        want[r["doc_id"]] += len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    got, used = collections.Counter(), collections.Counter()
    for r in steps[5][1]:
        got[r["doc_id"]] += r["length"]
        used[r["sequence_id"]] += r["length"]
    assert got == want
    assert all(n <= 4096 and n & (n - 1) == 0 for n in used.values())


def test_run_is_the_stages_in_turn(spark, steps):
    key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = collections.Counter(tuple(r[c] for c in key) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == collections.Counter(tuple(r[c] for c in key) for r in steps[5][1])
