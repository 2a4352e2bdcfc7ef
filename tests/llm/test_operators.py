"""Each operator against brute force on small fixtures, and with nulls, ties, long texts and empty tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pagewright.llm import bpe, decontamination, katz, language, quality, secret_scan, simhash, suffix_dedup, toxicity, warc
from pagewright.llm.blocks import Block, packed, unpacked

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = "doc_id long, text string, lang string, label int, fp long, block long, kept boolean, held_out boolean, component_id long, kept_doc_id long"
W = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, ties, repeated rows, a long text and columns of clashing names."""
    rng = random.Random(4)
    long = prose(rng, 120_000, 5000)
    texts = [(1, None), (2, ""), (3, " \t\n "), (4, "a b c"), (4, "a b c"), (5, "é ß 日本 😀"), (6, long), (7, "x" * 200_000), (None, "a b c"), (8, prose(rng, 80)), (9, "\x00\x1c\x85 z")]
    return spark.createDataFrame([(i, t, None, 1, 2, 3, True, False, 4, 5) for i, t in texts], ODD)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# quality rules


def test_quality_counts_match_plain_ones(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(prose(rng, rng.randint(0, 30), 25) + rng.choice(["", " #x", "$ %", "\t"]) for _ in range(rng.randint(0, 6)))) for i in range(80)]
    got = {r.doc_id: r for r in quality.apply(docs(spark, rows), None).collect()}
    for i, t in rows:
        w = W.findall(t)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {k + d for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if W.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (not r.base_failed or not r.kept)


def test_forest_rejects_junk_and_keeps_clean_rows(spark):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(600):
        bad = i % 8 == 0
        rows.append((i, prose(rng, 120, 9000) if not bad else " ".join(f"{w}###$$$" for w in prose(rng, 120, 9000).split())))
        marks.append((i, 0 if bad else 1, None))
    d = docs(spark, rows)
    forest = quality.fit(d, labels(spark, [m for m in marks if m[0] % 2]) .union(labels(spark, [m for m in marks if m[0] % 16 == 0])))
    kept = {r.doc_id: r.kept for r in quality.apply(d, forest).collect()}
    held = [i for i in range(600) if i % 2 == 0 and i % 16]
    assert sum(kept[i] for i in held if i % 8) >= 0.97 * sum(1 for i in held if i % 8)
    assert not any(kept[i] for i in range(600) if i % 8 == 0)
    assert {r.doc_id for r in quality.kept_documents(d, forest).collect()} == {i for i, k in kept.items() if k}


def test_quality_odd_rows(spark, odd):
    assert quality.apply(odd, None).count() == odd.count()
    assert quality.fit(empty(spark), labels(spark, [])) is None
    assert quality.apply(empty(spark), None).count() == 0 and set(quality.kept_documents(odd, None).columns) == set(odd.columns)


# language


def test_marginals_match_one_chain_at_a_time():
    rng = np.random.default_rng(0)
    lengths, moves = np.array([1, 100, 32, 33, 17]), rng.normal(0, 1, (3, 3))
    e = rng.normal(0, 2, (lengths.sum(), 3))
    got, at = language.marginals(e, lengths, moves), 0
    for n in lengths:
        x, a = np.exp(e[at : at + n]), np.exp(moves)
        alpha, beta = [x[0]], [np.ones(3)]
        for k in range(1, n):
            alpha.append((alpha[-1] @ a) * x[k])
            alpha[-1] /= alpha[-1].sum()
        for k in range(n - 2, -1, -1):
            beta.insert(0, a @ (beta[0] * x[k + 1]))
            beta[0] /= beta[0].sum()
        p = np.array(alpha) * np.array(beta)
        assert np.allclose(p / p.sum(1, keepdims=True), got[at : at + n])
        at += n


def test_language_of_held_out_and_switched_texts(spark, odd):
    rng = random.Random(3)
    stems = {"aa": ["lor", "mip", "sum", "dol"], "bb": ["kra", "zik", "vuk", "trz"], "cc": ["ñao", "ieé", "ouà", "aei"]}
    word = lambda y: "".join(rng.choice(stems[y]) for _ in range(rng.randint(1, 3)))
    rows = [(i, " ".join(word(y) for _ in range(rng.randint(5, 40))), y, "s", 0) for i, y in enumerate(["aa", "bb", "cc"] * 60)]
    d = spark.createDataFrame(rows, DOCS)
    model = language.fit(d)
    got = {r.doc_id: r for r in language.apply(d, model).collect()}
    assert all(got[i].lang_pred == y for i, _, y, *_ in rows if got[i].held_out) and all(0 <= r.score <= 1 for r in got.values())
    mixed = [word("aa").encode() for _ in range(12)] + [word("bb").encode() for _ in range(12)]
    p, _ = language.Labeller(model).probabilities([mixed])
    assert [model.labels[k] for k in p.argmax(1)] == ["aa"] * 12 + ["bb"] * 12
    out = [r for r in language.apply(odd, model).collect()]
    assert len(out) == odd.count() and {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    none = language.fit(empty(spark))
    assert {r.lang_pred for r in language.apply(odd, none).collect()} == {"und"} and language.apply(empty(spark), none).count() == 0


def test_features_do_not_depend_on_the_words_beside():
    f, cut = language.features([b"alpha", b"12", b"b", "ñandú".encode(), b"alpha"])
    one = lambda k: sorted(f[cut[k] : cut[k + 1]].tolist())
    assert one(0) == one(4) and one(1) == [] and one(0) == sorted(language.features([b"alpha"])[0].tolist())
    assert one(2) == sorted(language.features([b"b"])[0].tolist()) and one(3) == sorted(language.features(["ñandú".encode()])[0].tolist())


# WARC


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "u", None, 0), (2, "u", "", 0), (3, None, "abc", 0), (4, "u v", "abc", 0), (4, "u", "abc", 0), (5, "u", "é" * 100, 0), (None, "u", "abc", 0), (6, "u", "y" * 300_000, 0)], "page_id long, url string, html string, often int")
    got = {(r.page_id, r.payload_bytes): r for r in warc.round_trip(pages).collect()}
    name = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert got[4, 3].record_type == "response" and got[4, 3].refers_to is None and got[3, 3].refers_to == 4 and got[None, 3].refers_to == 4
    assert got[1, 0].record_type == "revisit" and got[1, 0].refers_to == 2 and got[5, 200].payload_digest == name(("é" * 100).encode())
    assert got[6, 300_000].record_type == "response" and warc.round_trip(pages).count() == 8 and warc.round_trip(pages.limit(0)).count() == 0


def test_archive_starts_with_its_dictionary_and_records_stand_alone():
    records = [warc.record(i, "u", f"<html>{i % 7} text {i}</html>".encode() * 20, None, True) for i in range(60)]
    parts = list(warc.archive(records, 3, 4096, 100_000))
    assert parts[0][:4] == warc.SKIPPABLE and len(parts) == 61
    import io

    assert list(warc.frames(io.BytesIO(b"".join(parts)), 100)) == records
    assert list(warc.frames(io.BytesIO(parts[0] + parts[7]), 100)) == [records[6]]


# toxicity


def test_toxicity_learns_a_pair_that_single_terms_do_not_show(spark, odd):
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(900):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        t = prose(rng, 30) + (" blorgface" if insult else "") + (" zanties" if group else "")
        rows.append((i, t))
        marks.append((i, 1, int(insult and group)))
    d = docs(spark, rows)
    machine = toxicity.fit(d, labels(spark, marks))
    got = {r.doc_id: r for r in toxicity.apply(d, machine).collect()}
    held = [(got[i].predicted, y) for i, _, y in marks if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97 and all(r.predicted == (r.score >= 0.7) for r in got.values())
    assert toxicity.apply(odd, machine).count() == odd.count()
    none = toxicity.fit(empty(spark), labels(spark, []))
    assert all(0 <= r.score <= 1 for r in toxicity.apply(odd, none).collect()) and toxicity.apply(empty(spark), none).count() == 0


# decontamination


def test_items_are_found_as_by_brute_force(spark, odd):
    rng = random.Random(6)
    items = [(k, prose(rng, rng.choice([3, 5, 12, 20, 45, 90]), 3000)) for k in range(30)] + [(30, None), (31, ""), (32, " ... ")]
    rows = []
    for i in range(150):
        t = prose(rng, rng.randint(0, 900), 3000).split()
        for _ in range(rng.randint(0, 2)):
            w = items[rng.randrange(30)][1].upper().split()
            w = w[: max(1, int(len(w) * rng.choice([1, 1, 0.9, 0.6])))]
            at = rng.randint(0, len(t))
            t[at:at] = w if rng.random() < 0.7 else [*w[: len(w) // 2], *prose(rng, 60, 3000).split(), *w[len(w) // 2 :]]
        rows.append((i, ", ".join(t)))
    rows += [(200, items[0][1]), (201, None), (202, "")]
    want = set()
    own = {k: decontamination.shingles(decontamination.words((t or "").encode())) for k, t in items}
    for i, t in rows:
        s = decontamination.shingles(decontamination.words((t or "").encode()))
        want |= {(i, k) for k, q in own.items() if q and len(s & q) >= 0.8 * len(q)}
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    d = docs(spark, rows)
    for most in (20_000, 10):
        found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(d, bench, most).collect()}
        assert found == want and len(want) > 50
    clean = {r.doc_id for r in decontamination.clean_documents(d, bench, 10).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in want}
    assert decontamination.clean_documents(odd, bench).columns == odd.columns and decontamination.contaminated(empty(spark), bench).count() == 0
    assert decontamination.contaminated(d, bench.limit(0)).count() == 0


# SimHash


def plain_print(t):
    w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def parts_by_brute_force(prints, t):
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= t) + i + 1:
            up[root(int(j))] = root(i)
    return [root(k) for k in range(len(prints))]


def test_components_match_brute_force(spark, odd):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        t = prose(rng, 300, 3000).split()
        for c in range(rng.randint(1, 4)):
            u = list(t)
            for _ in range(rng.randint(0, 2)):
                u[rng.randrange(len(u))] = "edited"
            rows.append((i * 10 + c, " ".join(u).title()))
    rows += [(5000, ""), (5001, None), (5002, "one two")]
    got = {r.doc_id: r for r in simhash.linked(docs(spark, rows)).collect()}
    prints = np.array([plain_print(t) for _, t in rows], np.uint64)
    assert all(got[i].fingerprint == f"{int(p):016x}" for (i, _), p in zip(rows, prints))
    least = defaultdict(lambda: 1 << 60)
    roots = parts_by_brute_force(prints, 3)
    for (i, _), r in zip(rows, roots):
        least[r] = min(least[r], i)
    assert all(got[i].component_id == least[r] for (i, _), r in zip(rows, roots)) and len(set(roots)) < len(rows)
    kept = {r.doc_id for r in simhash.representatives(docs(spark, rows)).collect()}
    assert kept == set(least.values())
    out = simhash.linked(odd)
    assert out.count() == odd.count() and simhash.linked(empty(spark)).count() == 0
    stay = simhash.representatives(odd)
    assert stay.columns == odd.columns and sorted(r.doc_id for r in stay.collect()) == [1, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("crowd", [False, True])
def test_no_link_is_missed_at_any_level(spark, crowd):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = [base]
    for k in (1, 2, 3, 4):
        y = base.copy()
        for i in range(len(y)):
            for b in rng.choice(64, k, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        near.append(y)
    x = np.unique(np.concatenate(near))
    frame = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    crowded = [int(v) for v in simhash.Cover(3).home(x.view(np.int64) & simhash.MASK)] if crowd else []
    rows = simhash.anchored(frame, 3, crowded).repartition("anchor").sortWithinPartitions("anchor", "sent")
    root = {r.key: r.root for r in simhash.components(rows.mapInArrow(simhash.compare_sorted(3), "a long, b long")).collect()}
    want, got = defaultdict(set), defaultdict(set)
    for v, r in zip(x.view(np.int64).tolist(), parts_by_brute_force(x, 3)):
        want[r].add(v)
        got[root.get(v, v)].add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


# secrets

ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def test_spans_match_the_patterns(spark, odd):
    rng = random.Random(8)
    bits = ["password=", "Token : ", 'api_key="', "secret=token:", "AKIA" + "Q" * 16, "AKIAQ", "0123456789abcdef", "deadbeef", "x", " ", "é", "ſecret=abcdefghijklmn", "Aa0" * 8, "\n", "a1B2c3D4e5F6g7H8i9J0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(300)]
    got = {r.doc_id: r for r in secret_scan.scan(docs(spark, rows)).collect()}
    for i, t in rows:
        base = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, t) if len(m[1]) >= 12]
        n = len(base)
        access = [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        hexes = [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(base + access + hexes))
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex, got[i].base_sha256) == (n, len(access), len(hexes), hashlib.sha256(text.encode()).hexdigest())
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("entropy")] == [s for s in text.split(",") if s]
    assert secret_scan.scan(odd).count() == odd.count() and secret_scan.scan(empty(spark)).count() == 0
    assert secret_scan.redacted(odd).columns == odd.columns


def test_entropy_windows_match_plain_computation():
    rng = random.Random(9)
    for limit in (2.9, 3.6):
        for _ in range(60):
            s = "".join(rng.choice("0123456789abcdef" if rng.random() < 0.5 else "abAB01") for _ in range(rng.randint(20, 70)))
            hot = set()
            for k in range(len(s) - 19):
                c = Counter(s[k : k + 20])
                if -sum(n / 20 * math.log2(n / 20) for n in c.values()) >= limit - 1e-9:
                    hot |= set(range(k, k + 20))
            assert {p for a, b in secret_scan.high_entropy(s, limit) for p in range(a, b)} == hot
    assert secret_scan.entropy_spans("antidisestablishmentarianism hello-world-and-more-words 123e4567-e89b-12d3-a456-426614174000") == []
    assert secret_scan.entropy_spans("k 9fQ2xLr7Zt0vKpB4mWsYhd3G") == [(2, 26)]
    assert secret_scan.masked("token = 0123456789abcdefXY end", "*") == "* end"


# Katz


def brute_katz(rows, order):
    split = [(i, re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split() + ["</s>"], zlib.crc32(str(i).encode()) % 7 == 2) for i, t in rows]
    count = [Counter() for _ in range(order + 1)]
    for _, w, out in split:
        for n in range(1, order + 1) if not out else ():
            s = ["<s>"] * (n - 1) + w
            count[n].update(tuple(s[k : k + n]) for k in range(len(w)))
    totals = [None] + [katz.Totals.of(np.array([sum(1 for v in count[n].values() if v == r) for r in range(1, 7)] + [sum(count[n].values()), len(count[n])])) for n in range(1, order + 1)]
    size, seen = totals[1].tokens, totals[1].seen
    d = lambda n, c: float(totals[n].discount(np.array([c]))[0])
    held = sum(v * (1 - d(1, v)) for v in count[1].values())
    whole = size + (held <= 0)
    after = [None] + [defaultdict(dict) for _ in range(order)]
    for n in range(2, order + 1):
        for g, v in count[n].items():
            after[n][g[:-1]][g[-1]] = v
    memo = {}

    def p(h, w):
        n = len(h) + 1
        if n == 1:
            c = count[1][(w,)]
            return d(1, c) * c / whole if c else (held or 1) / whole
        f = after[n].get(h)
        if not f:
            return p(h[1:], w)
        if h not in memo:
            total, away = sum(f.values()), sum(v * (1 - d(n, v)) for v in f.values())
            total, away = (total, away) if away > 0 else (total + 1, 1)
            memo[h] = total, away / total / (1 - sum(p(h[1:], x) for x in f))
        return d(n, f[w]) * f[w] / memo[h][0] if w in f else memo[h][1] * p(h[1:], w)

    vocabulary = [x for (x,) in count[1]] + ["<unk>"]
    for h in list(after[order] or ())[:5]:
        assert abs(sum(p(h, x) for x in vocabulary) - 1) < 1e-9
    out = {}
    for i, w, o in split:
        s = ["<s>"] * (order - 1) + [x if (x,) in count[1] else "<unk>" for x in w]
        out[i] = (o, len(w), sum((x,) in count[1] for x in w), size, sum(math.log10((count[1][(x,)] + 1) / (size + seen + 1)) for x in w), sum(math.log10(p(tuple(s[k : k + order - 1]), s[k + order - 1])) for k in range(len(w))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_matches_brute_force_and_sums_to_one(spark, order):
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.randint(0, 40), rng.choice([3, 60, 900]))) for i in range(200)] + [(900, None), (901, ""), (902, "ZZ top w1 W2"), (903, "w1 w1\tw1\nw1")]
    got = {r.doc_id: tuple(r)[1:] for r in katz.score(docs(spark, rows), order, block_bytes=2000, bucket_bytes=4000).collect()}
    want = brute_katz(rows, order)
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][:4] == want[i][:4] and got[i][4:] == pytest.approx(want[i][4:], abs=1e-9)


def test_katz_odd_rows(spark, odd):
    out = katz.score(odd).collect()
    assert len(out) == odd.count() and sum(r.doc_id is None for r in out) == 1 and all(r.n_tokens >= 1 and r.score <= 0 for r in out)
    assert katz.score(empty(spark)).count() == 0


# BPE


def test_encodings_are_the_library_s(spark, odd):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("word_bpe_49k.json")
    rng = random.Random(11)
    alphabet = "abcdefgh tion ing THE éàÉß ' '' 's 're 12 3 ! ?! ### -- \n \t \x1c \x85   日本 😀 Σς İ ﬁ é <|endoftext|> <|startoftext|> < |".split(" ") + [" "] * 8
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["x" * 500, "!" * 300, "Hello, World! It's don't."]
    model = bpe.Model(path)
    assert model.plain
    for text, ids in zip(texts, model.encode(texts)):
        want = model.library.encode(text, add_special_tokens=False).ids
        assert list(array("I", ids)) == want and model.decode(ids) == model.library.decode(want, skip_special_tokens=False)
    rows = list(enumerate(texts[:40])) + [(100, None), (101, "")]
    got = {r.doc_id: r for r in bpe.encoded(docs(spark, rows), path).collect()}
    digests = {r.doc_id: r for r in bpe.digests(docs(spark, rows), path).collect()}
    for i, t in rows:
        ids = model.library.encode(t or "", add_special_tokens=False).ids
        assert list(got[i].ids) == ids and digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest() and digests[i].decoded_sha256 == hashlib.sha256(got[i].decoded.encode()).hexdigest()
    assert bpe.digests(odd, path).count() == odd.count() and bpe.digests(empty(spark), path).count() == 0


# suffixes


def brute_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            gone[p : p + 100] |= w in seen
            seen.add(w)
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[i] = (len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


@pytest.mark.parametrize("block_bytes", [3000, 200_000])
def test_repeats_match_brute_force(spark, block_bytes):
    rng = random.Random(12)
    shared = [prose(rng, 40, 300) for _ in range(5)]
    rows = []
    for i in range(110):
        t = prose(rng, rng.randint(0, 90), 300) + " é"
        for _ in range(rng.randint(0, 3)):
            t += " " + rng.choice(shared)[rng.randint(0, 60) :] + prose(rng, rng.randint(0, 5), 300)
        if rng.random() < 0.2:
            t += t[:200]
        if rows and rng.random() < 0.1:
            t = rng.choice(rows)[1]
        rows.append((i * 3 if i % 2 else 2000 - i, t))
    rows += [(5000, None), (5001, ""), (5002, "a" * 700), (5003, "ab" * 300), (5004, "a" * 99), (5005, "a" * 100), (5006, "x" + "ab" * 80)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeats(docs(spark, rows), block_bytes, 20_000).collect()}
    assert got == brute_repeats(rows)
    left = {r.doc_id: bytes(r.text) for r in suffix_dedup.deduplicated(docs(spark, rows), block_bytes, 20_000).collect()}
    assert all(hashlib.sha256(left[i]).hexdigest() == got[i][3] for i in got)


def test_repeats_odd_rows(spark, odd):
    out = suffix_dedup.repeats(odd).collect()
    assert len(out) == odd.count() and sum(r.doc_id is None for r in out) == 1 and next(r for r in out if r.doc_id == 7).n_removed > 199_000
    assert suffix_dedup.repeats(empty(spark)).count() == 0


def test_merge_gives_sorted_suffixes_and_true_prefixes():
    rng = random.Random(13)
    runs = []
    for k in range(5):
        words = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(32, 60))) for _ in range(rng.randint(1, 40)))
        shared, rest = suffix_dedup.front_coded(words)
        n = len(words)
        runs.append((words, packed(np.array([k]), shared, np.array([len(w) for w in words], np.uint8), rest, b"", np.zeros(n, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64))))
    out, last = [], b""
    for r, row, shared in suffix_dedup.merged([suffix_dedup.Run(k, b) for k, (_, b) in enumerate(runs)]):
        assert r.head == runs[r.index][0][row] and shared == suffix_dedup.common(last, r.head, 0)
        last = r.head
        out.append(last)
    assert out == sorted(w for ws, _ in runs for w in ws)


def test_packed_blocks_come_back():
    b = Block(np.array([3, -5]), np.array([2, 0]), b"xy")
    c = Block.of(packed(b.ids, b.sizes, b.data))
    assert c.ids.tolist() == [3, -5] and c.texts() == [b"xy", b""]
    assert [x.tolist() for x in unpacked(packed(np.array([1, 2], np.uint16), np.array([], np.float64)), np.uint16, np.float64)] == [[1, 2], []]
