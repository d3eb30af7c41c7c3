"""Fill-in-middle, spelling variants and sharding against brute force and on odd rows."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest
from cases import DOCUMENTS, collected, none, odd_documents, odd_rows, with_clashes, words

from cohortlens.llm import infill, sharding, variants

RUNS = {"op11": infill.digests, "op12": variants.spelling_variants, "op13": sharding.shards}


def table(spark, texts):
    return spark.createDataFrame([(i + 1, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCUMENTS)


@pytest.mark.parametrize("name", RUNS)
def test_other_columns_do_not_matter_and_reruns_agree(spark, name):
    plain = collected(RUNS[name](odd_documents(spark)))
    assert collected(RUNS[name](with_clashes(odd_documents(spark).repartition(5)))) == plain
    if name != "op12":
        assert len(plain) == len(odd_rows())


@pytest.mark.parametrize("name", RUNS)
def test_an_empty_table_gives_no_rows(spark, name):
    assert RUNS[name](none(spark)).collect() == []


# Fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def infilled(doc_id, text):
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def infill_texts():
    rng = random.Random(3)
    parts = ["a", "é", "日本", " ", "\n", "\t ", "\x85", " ", "<", "P>", "<S", "<M", ">", "x<", "word", "\x0b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return texts + [None, "", " ", "a <P> b", "<S>", "<M>", words(40_000, 5), "\n\n" + words(30, 6) + "\n"]


def test_infilling_equals_the_plain_rule_and_is_undone(spark):
    texts = infill_texts()
    df = table(spark, texts)
    want = [(i + 1, *infilled(i + 1, t or "")) for i, t in enumerate(texts)]
    written = infill.transform(df)
    assert collected(written) == sorted(want, key=repr)
    assert collected(infill.restored(written)) == sorted(((i + 1, t or "") for i, t in enumerate(texts)), key=repr)
    forms = collections.Counter(w[2] for w in want)
    assert min(forms[f] for f in ("plain", "spm", "psm")) > 10

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    digests = [(*w[:5], sha(w[5]), sha(t or "")) for w, t in zip(want, texts)]
    assert collected(infill.digests(df)) == sorted(digests, key=repr)


def test_shares_are_parameters(spark):
    df = table(spark, [words(9, i) for i in range(60)])
    assert {r.form for r in infill.transform(df, changed=0).collect()} == {"plain"}
    assert {r.form for r in infill.transform(df, changed=100, spm=0).collect()} == {"psm"}
    assert {r.form for r in infill.transform(df, changed=100, spm=100).collect()} == {"spm"}


def test_every_cut_is_undone():
    text = "<é x>< P> <S <M".encode()
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            for form in infill.FORMS:
                assert infill.restore(infill.arrange(text, a, b, form).content(), form).content() == text


def test_a_broken_form_is_told():
    with pytest.raises(ValueError, match="no <M>"):
        infill.restore(b"<P>a<S>b", "psm")


# Spelling variants

def near_by_brute_force(vocabulary):
    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    return {w: [o for o in vocabulary if o != w and one_edit(w, o)] for w in vocabulary}


def variants_by_brute_force(rows):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{low}".encode())
            at = h % len(low)
            count[low if h % 31 else low[:at] + low[at + 1 :]] += 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    near = near_by_brute_force(count)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-count[o], o))
            if count[best] >= 10 * count[w]:
                form[w] = best
    out = []
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, count[w], len(near[w]), count.get(form.get(w))))
    return sorted(out, key=repr)


def misspelt(seed):
    rng = random.Random(seed)
    letters = "abéÀÿz"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(25)]
    texts = []
    for _ in range(120):
        run = []
        for _ in range(40):
            w = base[min(int(rng.expovariate(0.2)), len(base) - 1)]
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
                i = rng.randrange(len(w))
                w = rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]))
            run.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        texts.append(rng.choice((" ", "-", "1")).join(run))
    return [*texts, texts[0], None, "", "A" * 30 + " " + "a" * 31 + " " + "a" * 30 + " " + "a" * 31]


@pytest.mark.parametrize("most", [1, 16, 4096])
def test_variants_equal_brute_force_whatever_is_cut_further(spark, monkeypatch, most):
    monkeypatch.setattr(variants, "MOST_PAIRS", most)
    texts = misspelt(1)
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(None, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = variants_by_brute_force(rows)
    assert collected(variants.spelling_variants(df)) == want
    assert sum(r[1] is not None for r in want) > 20


def test_pairs_of_any_length(spark):
    rng = random.Random(2)
    some = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(90)})
    some += ["x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1500]
    df = spark.createDataFrame([(w,) for w in some], "word string")
    got = sorted(tuple(sorted(r)) for r in variants.near_pairs(df).collect())
    assert got == sorted({tuple(sorted((a, b))) for a, others in near_by_brute_force(some).items() for b in others})


def test_a_long_way_to_the_root(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    assert {r.root for r in variants.roots(forms).collect()} == {"w11"}


# Sharding

def heap_schedule(classes, n):
    heap = [(0, i) for i in range(n)]
    out = []
    for size, count in classes:
        got = [0] * n
        for _ in range(count):
            x, i = heap[0]
            heapq.heapreplace(heap, (x + size, i))
            got[i] += 1
        out.append(got)
    return out


def test_the_schedule_is_that_of_a_heap_over_single_groups():
    rng = random.Random(4)
    for n in (1, 3, 24):
        for _ in range(60):
            sizes = sorted({rng.choice((rng.randint(1, 50), rng.randint(1, 5000))) for _ in range(12)}, reverse=True)
            classes = [(s, rng.choice((1, 2, 30, 700))) for s in sizes]
            assert sharding.schedule(classes, n) == heap_schedule(classes, n)


def shard_rows(spark, rows):
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    slots, loads = collections.defaultdict(list), [0] * sharding.SHARDS
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    for used in slots.values():
        assert sorted(used) == list(range(len(used)))
    shard_of = collections.defaultdict(set)
    text = {i: t or "" for i, t in rows}
    for r in got:
        shard_of[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    return loads


def test_shards_hold_groups_together_and_differ_by_a_group(spark):
    rng = random.Random(5)
    texts = [words(rng.randint(0, 60), i) for i in range(700)]
    rows = [(i, rng.choice(texts[:30]) if rng.random() < 0.3 else texts[i % 700]) for i in range(1500)]
    rows += [(7001, None), (7002, ""), (7003, "é" * 40)]
    group = collections.Counter()
    for _, t in rows:
        group[t or ""] += len((t or "").encode()) + 8
    loads = shard_rows(spark, rows)
    assert max(loads) - min(loads) <= max(group.values())


def test_a_group_with_a_third_of_the_rows(spark):
    rows = [(i, words(20, 3) if i % 3 == 0 else words(20, 100 + i)) for i in range(900)]
    loads = shard_rows(spark, rows)
    hot = 300 * (len(words(20, 3)) + 8)
    rest = sorted(loads)[:-1]
    assert max(loads) == hot and max(rest) - min(rest) <= 250


def test_classes_keep_the_leading_digits(spark):
    sizes = [1, 8, 4095, 4096, 4097, 8191, 8193, 123_456_789]
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    got = [r[0] for r in df.select(sharding._class(df["s"], 12)).collect()]
    assert got == [s >> max(s.bit_length() - 12, 0) << max(s.bit_length() - 12, 0) for s in sizes]


def test_equal_rows_are_numbered_one_by_one(spark):
    got = sharding.shards(spark.createDataFrame([(1, "a b c")] * 50 + [(None, None)] * 3, "doc_id long, text string")).collect()
    by_shard = collections.defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert sorted(map(sorted, by_shard.values())) == [list(range(3)), list(range(50))]
