"""Operators on documents against brute force, on odd rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import collected, none, odd_documents, odd_rows, with_clashes, words
from tokenizers import Tokenizer

from cohortlens.llm import bpe, fingerprints, language, licenses, mixing, neardup, pii, toxicity
from cohortlens.llm.queries import WORD_BPE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


RUNS = {
    "op1": lambda spark, d: fingerprints.fingerprints(d),
    "op2": lambda spark, d: pii.find(d),
    "op4": lambda spark, d: bpe.encode_digests(d, WORD_BPE),
    "op5": lambda spark, d: neardup.near_duplicates(d),
    "op6": lambda spark, d: mixing.taken(d),
    "op7": lambda spark, d: licenses.scan_summary(d),
    "op8": lambda spark, d: language.scores(d),
    "op9": lambda spark, d: toxicity.scored(d, labels(spark, [(3, 1, 0), (5, 1, 1), (8, 1, None)])),
}


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows_give_a_row_each_whatever_other_columns_there_are(spark, name):
    plain = collected(RUNS[name](spark, odd_documents(spark)))
    assert len(plain) == len(odd_rows())
    assert collected(RUNS[name](spark, with_clashes(odd_documents(spark)))) == plain


@pytest.mark.parametrize("name", RUNS)
def test_an_empty_table_gives_no_rows(spark, name):
    assert RUNS[name](spark, none(spark)).collect() == []


def test_encoding_equals_the_library(spark):
    library = Tokenizer.from_file(WORD_BPE)
    texts = [t or "" for _, t, *_ in odd_rows()] + [
        "Hello  world's we'll ...!!! 123 ñandú É  x y \x85z \x1c\x1d ​", "<|ENDOFTEXT|><|startoftext|>a",
        "aaaaaaaaaaaaaaaaaaaaa aaaa ababababab", "日本語テキスト 한국어 العربية", "\x00\x01",
    ]
    encoder = bpe.Encoder(bpe.Vocabulary(WORD_BPE))
    for text, (ids, shown) in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert shown == library.decode(want, skip_special_tokens=False)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.Encoder(bpe.Vocabulary(WORD_BPE))
    first = [list(encoder.encode([words(40, i), words(45, i + 1)])) for i in range(6)]
    monkeypatch.setattr(bpe, "REMEMBERED", 10**6)
    encoder = bpe.Encoder(bpe.Vocabulary(WORD_BPE))
    assert first == [list(encoder.encode([words(40, i), words(45, i + 1)])) for i in range(6)]


def test_a_full_memory_of_ids_keeps_the_words_at_hand(monkeypatch):
    batches = [[words(40, 1)], [words(40, 1) + " <|endoftext|> " + words(30, 2)], [words(30, 2) + " " + words(40, 3)], [words(40, 1)]]
    encoder = bpe.Encoder(bpe.Vocabulary(WORD_BPE))
    whole = [list(encoder.encode(b)) for b in batches]
    learnt, plain = [], bpe.Vocabulary.encode_words
    monkeypatch.setattr(bpe.Vocabulary, "encode_words", lambda self, new: learnt.append(len(new)) or plain(self, new))
    monkeypatch.setattr(bpe, "REMEMBERED", 60)
    encoder = bpe.Encoder(bpe.Vocabulary(WORD_BPE))
    assert whole == [list(encoder.encode(b)) for b in batches]
    # The second batch does not fit, but its first 40 words are known: only the others are encoded.
    assert learnt[1] <= 30


def test_merges_of_many_words_at_once_equal_those_of_one():
    vocabulary, rng = bpe.Vocabulary(WORD_BPE), random.Random(5)
    many = sorted({"".join(rng.choice("abén") * rng.randint(1, 5) for _ in range(rng.randint(1, 6))) for _ in range(400)})
    ids, at = vocabulary.encode_words(many)
    library = Tokenizer.from_file(WORD_BPE)
    for word, a, b in zip(many, at.tolist(), at.tolist()[1:]):
        assert ids[a:b].tolist() == library.encode(word, add_special_tokens=False).ids


def shingle_sets(rows):
    out = []
    for _, text, *_ in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def linked_components(rows):
    sets = shingle_sets(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, row in enumerate(rows):
        low[find(i)] = min(low.get(find(i), row[0]), row[0])
    return [(row[0], len(sets[i]), low[find(i)], low[find(i)] == row[0]) for i, row in enumerate(rows)]


def copies(seed, n=160):
    """Groups of copies with more and more edits, so that links form chains and near misses."""
    rng = random.Random(seed)
    rows = []
    for group in range(6):
        text = words(rng.randint(3, 120), 100 + group).split()
        for _ in range(n // 6):
            if rng.random() < 0.7:
                text = list(text)
                text[rng.randrange(len(text))] = f"w{rng.randrange(50)}"
            rows.append((len(rows) * 3 + 1, " ".join(text), "en", "s", 0))
    return rows


@pytest.mark.parametrize("blocks", [(512, 8192), (8, 8)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(neardup, "LEAST_BLOCK", blocks[0])
    monkeypatch.setattr(neardup, "LARGEST_BLOCK", blocks[1])
    rows = copies(7)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert collected(neardup.near_duplicates(df)) == sorted(linked_components(rows), key=repr)


def test_a_pair_at_the_threshold_is_missed_as_rarely_as_stated():
    n, p = neardup.COORDINATES, neardup.SIMILAR / 100
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(neardup.MATCHES)) < 6e-7
    assert neardup.PREFIX == n - neardup.MATCHES + 1


def test_one_document_of_a_group_stays(spark):
    kept = [r["doc_id"] for r in neardup.deduplicated(odd_documents(spark)).collect()]
    assert sorted(i or 0 for i in kept) == [0, 1, 2, 3, 4, 5, 9, 10, 11, 12, 13, 15]


@pytest.mark.parametrize("one_task", [0, 40, 20_000])
def test_components_in_few_tables(spark, monkeypatch, one_task):
    """A rising chain, a star with a high centre and scattered links, with and without the last step in one task."""
    rng = random.Random(3)
    links = {(i, i + 1) for i in range(400)} | {(i, 2000) for i in range(1000, 1050)}
    links |= {tuple(sorted(rng.sample(range(3000, 3300), 2))) for _ in range(200)}
    root = {x: x for pair in links for x in pair}
    for _ in root:
        if not (moved := [(a, b) for a, b in links if root[a] != root[b]]):
            break
        for a, b in moved:
            root[a] = root[b] = min(root[a], root[b])
    written, keep = [], neardup.kept
    monkeypatch.setattr(neardup, "kept", lambda df: written.append(1) or keep(df))
    monkeypatch.setattr(neardup, "ONE_TASK", one_task)
    found = neardup.components(spark.createDataFrame(sorted(links), "a long, b long")).select("node", "component")
    assert dict(collected(found)) == root
    # Rounds that follow two hooks at a time wrote 403 tables: as many as the chain has links.
    assert len(written) <= (1 if one_task == 20_000 else 40)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 400)] + [(1000, 1001), (1000, 1005)]
    found = dict(collected(neardup.components(spark.createDataFrame(links, "a long, b long")).select("node", "component")))
    assert found == {i: 1 for i in range(1, 401)} | {1000: 1000, 1001: 1000, 1005: 1000}


def test_edited_texts_and_likeness(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 13]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(df).collect()}
    ordered = sorted(rows)
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        # The anchors of the parts and the seam are those of the whole edited text.
        assert row["edited_fingerprint"] == fingerprints.written(fingerprints.sketch(fingerprints.anchors(edited), edited))
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert found[5]["fingerprint"] == found[6]["fingerprint"] and found[5]["near_next"] == 1.0


def test_syncmers_are_windows_whose_smallest_inner_string_is_at_an_edge():
    text = words(400, 5)
    at, hashes = fingerprints.anchors(text)
    codes = fingerprints._codes(text)
    for i in range(len(text) - fingerprints.WINDOW + 1):
        window = text[i : i + fingerprints.WINDOW]
        own = fingerprints._windows(codes[i : i + fingerprints.WINDOW])
        assert (i in at) == (len(own[0]) == 1), window
    moved_at, moved = fingerprints.anchors("##" + text)
    assert set(hashes.tolist()) <= set(moved.tolist())


def test_long_texts_are_cut_without_losing_anchors(monkeypatch):
    text = words(3000, 9)
    whole = fingerprints.anchors(text)
    monkeypatch.setattr(fingerprints, "PIECE", 1000)
    for got in (fingerprints.anchors(text), fingerprints.batch_anchors(["ab", text, ""])[1]):
        assert [x.tolist() for x in got] == [x.tolist() for x in whole]


FORMATS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def formats(text):
    return [
        (k, *m.span()) for k, (kind, (pattern, good)) in enumerate(FORMATS.items()) for m in re.finditer(pattern, text) if good(m[0])
    ]


def test_base_spans_equal_the_plain_expressions():
    rng = random.Random(3)
    alphabet = "ab.@-_+1234 ()\n%é"
    parts = ["a@b.c", "x.y@z-1.com.", "1.2.3.4", "255.256.1.1", "4111 1111 1111 1111", "4799134681044206", "+1 (319) 555-5132", "+44.20.7946.0958", "00001.2.3.4"]
    for _ in range(3000):
        text = "".join(rng.choice([rng.choice(alphabet), rng.choice(parts)]) for _ in range(rng.randint(0, 25)))
        assert sorted(pii.base_spans(text)) == sorted(formats(text)), text


def test_patterns_find_unseen_identifiers_and_leave_other_numbers_alone(spark):
    rows = []
    for i in range(60):
        number = f"+1 555 {200 + i} {1000 + i}" if i % 6 else f"555-{200 + i}-{1000 + i}"
        rows.append((i, f"{words(8, i)} call me at {number} {words(5, i + 500)}", "en", "s", 0))
        rows.append((1000 + i, f"{words(8, i + 50)} order {7000000 + i} of {words(3, i)} {words(9, i)}", "en", "s", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r for r in pii.find(df).collect()}
    texts = {r[0]: r[1] for r in rows}
    for i in range(0, 60, 6):
        number = f"555-{200 + i}-{1000 + i}"
        start = texts[i].index(number)
        assert found[i]["spans"] == f"phone:{start}:{start + len(number)}" and found[i]["n_phone"] == 0
    assert all(found[1000 + i]["spans"] == "" for i in range(60))
    masked = {r["doc_id"]: r for r in pii.masked(df).collect()}
    assert all("[PHONE]" in masked[i]["text"] and "555" not in masked[i]["text"] for i in range(60))
    assert masked[1000]["text"] == texts[1000] and masked[6]["n_chars"] == len(masked[6]["text"])


def test_copies_of_a_text_do_not_spoil_a_pattern(spark):
    rows = []
    for i in range(60):
        number = f"+1 555 {200 + i} {1000 + i}" if i % 6 else f"555-{200 + i}-{1000 + i}"
        rows.append((i, f"{words(8, i)} phone: {number} {words(5, i + 500)}", "en", "s", 0))
    rows += [(1000 + i, "the phone: please ask", "en", "s", 0) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r["n_added"] for r in pii.find(df).collect()}
    assert all(found[i] == (i % 6 == 0) for i in range(60)) and not any(found[1000 + i] for i in range(600))


def test_a_long_word_leaves_the_word_after_it_as_context():
    for text, want in [
        ("x" * 300 + " phone: 1", "phone: "), ("x" * 300 + " 1", ""), ("a " + "x" * 192 + " phone: 1", "x" * 192 + " phone: "),
        ("call me at 1", "me at "), ("phone: 1", "phone: "), ("1", ""),
    ]:
        assert pii._contexts(text, [(3, len(text) - 1, len(text))]) == [want]


def test_targets_by_capping_and_resharing(spark):
    rows = [(f"d{i}", s, size) for i, (s, size) in enumerate([("a", 10), ("b", 500), ("c", 400), ("d", 7), (None, 0), ("e", 90)])]
    df = spark.createDataFrame([(s, size) for _, s, size in rows], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    order = sorted((r[1] for r in rows), key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    size = {s: n for _, s, n in rows}
    total, capped = 1.5 * sum(size.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > 2 * size[s]]
        if not over:
            break
        capped |= {s: 2.0 * size[s] for s in over}
    want = shares | capped
    assert all(abs(found[s] - want[s]) < 1e-6 for s in order)


def test_mix_repeats_rows_as_often_as_they_are_taken(spark):
    rows = [(i, words(5 + i % 40, i), "en", f"s{i % 4}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r["doc_id"]: r for r in mixing.taken(df).collect()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert all(times[i] * taken[i]["size"] == taken[i]["taken"] for i in taken)
    assert all(r["taken"] <= 2 * r["size"] for r in taken.values())
    for s in range(4):
        own = [r for i, r in taken.items() if i % 4 == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 0.03 * own[0]["target"]


def test_language_counts_and_base_equal_brute_force(spark):
    rows = [(i, words(3 + i % 25, i % 37) + (" Rare%d" % i if i % 7 else ""), "en", "s", 0) for i in range(300)] + [(900, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r for r in language.scores(df).collect()}
    cut = {i: [*WORD.findall((t or "").translate(LOWER)), "\0end"] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in cut}
    counts = collections.Counter(w for i in cut if not held[i] for w in cut[i])
    n, v = sum(counts.values()), len(counts)
    for i, tokens in cut.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(tokens), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r["base_score"], sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert r["score"] < 0


def test_language_learns_from_every_training_text(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    several = spark.createDataFrame([(i, words(40, i)) for i in range(20)], "i long, text string")
    # A text that a sample of one in eight by its hash leaves out.
    text = several.where("pmod(xxhash64(text, 8), 8) != 0").orderBy("i").first()["text"]
    df = spark.createDataFrame([(i, text, "en", "s", 0) for i in range(400)], schema)
    table = language.frequent(language.counts(df))
    numbers, at, *_ = language.tokens(table, pa.RecordBatch.from_pydict({"text": [text]}))
    stream = language._streams(numbers, at)
    gain = language.learn(df, table).score(stream) - language.Network.start(table).score(stream)
    assert gain[0] > 20


def test_words_that_share_a_slot_of_the_index(monkeypatch):
    rng = np.random.default_rng(4)
    words_ = rng.integers(-2**62, 2**62, 3000)
    counts = np.sort(rng.integers(1, 99, 3000))[::-1]
    asked = np.concatenate((words_, words_ + 1, [0, -1, 7])).astype(np.int64)
    want = {w: i for i, w in enumerate(words_.tolist())}
    for slots in (1, 1 << 6, 1 << 20):
        monkeypatch.setattr(language, "SLOTS", slots)
        table = pickle.loads(pickle.dumps(language.Table(words_, counts, 5, 10**6, 3000, 3)))
        rank, count = table.look_up(asked.view(np.uint64))
        assert rank.tolist() == [want.get(w, -1) for w in asked.tolist()]
        assert count.tolist() == [int(counts[want[w]]) if w in want else 0 for w in asked.tolist()]


def test_language_training_takes_the_last_tokens_of_a_stream():
    table = language.Table(np.arange(10, 60, dtype=np.int64), np.full(50, 9), 5, 455, 51, 3)
    nets = []
    for last in (7, 8):
        nets.append(language.Network.start(table))
        # Three lanes of 33; the last one is filled up.
        nets[-1].train(np.array([5] * 96 + [last], np.int32), 0.005)
        assert all(np.isfinite(w).all() for w in nets[-1].w.values())
    assert abs(nets[0].w["word_w"] - nets[1].w["word_w"]).max() > 1e-3


def test_probabilities_add_up_to_one():
    words_, counts = np.arange(10, 60, dtype=np.int64), np.arange(60, 10, -1, dtype=np.int64)
    table = language.Table(words_, counts, 5, int(counts.sum()) + 5, 51, 3)
    net = language.Network.start(table)
    every = np.array([*range(50), language.RARE, language.END], np.int32)
    h = np.random.default_rng(0).standard_normal((1, language.HIDDEN)).astype(np.float32).repeat(len(every), 0)
    assert abs(np.exp(net.outputs(h, every)).sum() - 1) < 1e-4


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    counts = np.full(300, 5, np.int64)
    net = language.Network.start(language.Table(np.arange(300), counts, 9, 1600, 301, 4))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    before = rng.integers(0, 200, (3, 5)).astype(np.int32)
    before[1, 2] = language.BEGIN
    target = rng.integers(0, 200, (3, 5)).astype(np.int32)
    h = np.zeros((language.HIDDEN, 3))
    _, grad, _ = net.window(before, target, h)
    for name in ("u", "class_w", "word_b"):
        flat = net.w[name].reshape(-1)
        for i in np.argsort(-np.abs(grad[name].reshape(-1)))[:3]:
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = net.window(before, target, h)[0]
            flat[i] = old - eps
            down = net.window(before, target, h)[0]
            flat[i] = old
            assert math.isclose((up - down) / (2 * eps), grad[name].reshape(-1)[i], rel_tol=1e-2, abs_tol=1e-4)


def test_scores_equal_a_plain_walk_through_the_tokens():
    rng = np.random.default_rng(3)
    net = language.Network.start(language.Table(np.arange(200), np.full(200, 7), 9, 1500, 201, 4))
    w = net.w = {k: rng.standard_normal(v.shape) * 0.3 if k != "word_b" else v.astype(float) for k, v in net.w.items()}
    streams = [np.append(rng.integers(0, 200, n), language.END).astype(np.int32) for n in (0, 1, 63, 64, 150, 65)]
    streams[3][5] = language.RARE
    n = language.HIDDEN
    for stream, found in zip(streams, net.score(streams)):
        h, before, total = np.zeros(n), language.BEGIN, 0.0
        for token in stream.tolist():
            x, g = w["table"][before], h @ w["u"]
            z, r = (1 / (1 + np.exp(-(x[a : a + n] + g[a : a + n]))) for a in (0, n))
            h = (1 - z) * h + z * np.tanh(x[2 * n :] + r * g[2 * n :])
            group = token // language.CLASSES if token < language.WORDS else language.CLASSES + token - language.WORDS
            logit = h @ w["class_w"] + w["class_b"]
            total += logit[group] - np.log(np.exp(logit).sum())
            if token < language.WORDS:
                logit = h @ w["word_w"][group] + w["word_b"][group]
                total += logit[token % language.CLASSES] - np.log(np.exp(logit).sum())
            before = token
        assert math.isclose(found, total, rel_tol=1e-4)


def test_licenses_are_found_with_edits(spark):
    mit = licenses.TEMPLATES["MIT"]
    changed = mit.replace("charge", "cost").replace("publish, ", "").replace("persons", "other persons")
    rows = [
        (1, "Intro text here. " + mit + " The end."), (2, words(20, 1) + "\n" + changed), (3, words(200, 2)),
        (4, "x. Released under the MIT License. y"), (5, "Permission is hereby granted to nobody"), (6, ""),
    ]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r["matches"] for r in licenses.scan(df).collect()}
    (whole,), (edited,) = found[1], found[2]
    assert whole["license"] == "MIT" and whole["coverage"] == 1.0
    assert rows[0][1][whole["start"] : whole["end"]] == mit.rstrip(":")
    assert edited["license"] == "MIT" and 0.9 < edited["coverage"] < 1
    assert [m["license"] for m in found[4]] == ["MIT-line"]
    assert found[3] == found[5] == found[6] == []


def test_kernel_equals_the_sum_over_common_subsequences():
    from itertools import combinations

    def brute(s, t):
        def weights(x):
            out = collections.Counter()
            for c in combinations(range(len(x)), toxicity.ORDER):
                out["".join(x[i] for i in c)] += toxicity.DECAY ** (c[-1] - c[0] + 1)
            return out
        a, b = weights(s), weights(t)
        norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return sum(v * b[k] for k, v in a.items()) / norm if norm else 0.0

    names, strings = ["idiot", "loweis", "banana"], ["idiot", "idxiot", "ananas", "zz", "iiiii", "lowei"]
    got = toxicity.Kernel(names)(strings)
    for i, s in enumerate(strings):
        for j, t in enumerate(names):
            assert math.isclose(got[i, j], brute(s, t) ** toxicity.POWER, abs_tol=1e-4)


def test_words_are_cut_into_windows_all_at_once():
    odd = ["", "a", "naïve", "e\u0301te\u0301", "i.d.i.o.t", "ﬁnale", "i\u0307zmir", "x1y2", "großartigerweise", "ΑΣ".lower(), "12", "😀z", "abcdefgh", "abcdefghi"]
    plain = toxicity.letters_of(odd)
    assert plain == [toxicity.letters(w) for w in odd] and toxicity.letters_of([]) == []
    packed, owner = toxicity.windows(plain)
    cut = []
    for i, w in enumerate(plain):
        starts = [0] if len(w) <= 8 else [*range(0, len(w) - 8, 2), len(w) - 8]
        for at in starts:
            codes = [ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 5 for c in w[at : at + 8]]
            cut.append((sum(c << 5 * (7 - j) for j, c in enumerate(codes)), i))
    assert list(zip(packed.tolist(), owner.tolist())) == cut


def test_a_full_memory_keeps_the_words_at_hand(monkeypatch):
    batches = [[words(40, 1)], [words(40, 1) + " " + words(30, 2)], [words(30, 2) + ". " + words(40, 3)], [words(40, 1)]]
    kernel = toxicity.Kernel(["idiot", "abelo", "snar"])
    whole = [[r.tolist() for r in rows] for reader in [toxicity.Reader(kernel)] for b in batches for rows in reader.sentences(b)]
    learnt, cut = [], toxicity.letters_of
    monkeypatch.setattr(toxicity, "letters_of", lambda new: learnt.append(len(new)) or cut(new))
    monkeypatch.setattr(toxicity, "REMEMBERED", 60)
    reader = toxicity.Reader(kernel)
    assert whole == [[r.tolist() for r in rows] for b in batches for rows in reader.sentences(b)]
    # The second batch does not fit, but its first 40 words are known: only the others are learnt.
    assert learnt[1] <= 30


def test_toxic_sentences_are_told_apart_also_when_spelled_with_gaps(spark):
    insults = ["blorfik", "snargle", "quimpost"]
    rows, marks = [], []
    for i in range(400):
        text = f"{words(30, i)}. {words(12, i + 9000)}"
        toxic = i % 4 == 0
        if toxic:
            w = insults[i // 4 % 3]
            text += f" {w if i < 300 else '.'.join(w) if i % 8 else w[:3] + '-' + w[3:]} {words(4, i + 70)}."
        rows.append((i, text, "en", "s", 0))
        marks.append((i, 1, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = toxicity.scored(df, labels(spark, marks)).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = [r["doc_id"] for r in held if r["predicted"] != int(r["doc_id"] % 4 == 0)]
    assert len(wrong) <= 0.05 * len(held) and all(0 <= r["score"] <= 1 for r in found)
    clean = toxicity.clean(df, labels(spark, marks))
    assert clean.columns == df.columns and clean.count() == sum(r["predicted"] == 0 for r in found)
