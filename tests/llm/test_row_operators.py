"""Operators 3, 6, 8, 9 and 10 against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import packing, quality_rules, sanitise, secret_scan, sharding

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "one", "a b c a b c a b c", "x" * 5000, "é ü ß  word next \x1c x", "a@b.co%x@c.de y@z.org. 1.2.3.4.5.6.7.8 256.1.1.1 007.08.9.1"]
ODD += ["card 4111 1111 1111 1111, 4111-1111-1111-1112 +1 (415) 555-2671 + 12 +1234567", "+1" + " " * 300 + "2 +49 30 901820-0", "a." * 3000 + "@" + "b." * 3000 + "c"]
ODD += ['password = "hunter22" PASSWD:x api-key=abc123def TOKEN: zQ9$kf81Lm2xx secret="password1"', "AKIA" + "Z" * 15 + " AKIA" + "9" * 16 + "AKIA", "f" * 23 + " " + "0" * 24 + "g" + "a" * 50]
ODD += ["line one\nline one\n\n\nline one\n" + "w " * 60, "😀 mail 😀x@y.zz 😀 10.0.0.1", "#$%|<>& " * 70, "the same words again " * 40]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]


def spans(df, drop):
    return {r["key"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != drop] for r in df.collect()}


def test_personal_data_base_spans(documents):
    got = spans(sanitise.find(documents(ODD)), "term")
    assert got == {i: plain_personal(t or "") for i, t in enumerate(ODD)}


def test_personal_data_many_matches(documents):
    rng = random.Random(1)
    text = " ".join(rng.choice(["a@b.cc", "10.0.0.1", "word", "é"]) for _ in range(4000))
    assert spans(sanitise.find(documents([text])), "term")[0] == plain_personal(text)


def test_terms_that_disclose_an_entity(documents):
    texts = [f"note {i} from kestrel the keeper x{i} at mira@zoo.org about the n{i} news" for i in range(4)] + ["the keeper news about weather"] * 40
    df = documents(texts)
    found = sanitise.find(df)
    rows = {r["key"]: {texts[r["key"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "term"} for r in found.collect()}
    assert all("kestrel" in rows[i] and not rows[i] & {"the", "keeper", "news"} for i in range(4))
    assert not any(rows[i] for i in range(4, 44))
    joined = df.select("doc_id", F.col("text")).join(found.withColumnRenamed("key", "doc_id"), "doc_id")
    clean = {r[0]: r[1] for r in joined.select("doc_id", sanitise.generalise(F.col("text"), F.col("spans"))).collect()}
    assert "[email]" in clean[0] and "kestrel" not in clean[0] and clean[9] == texts[9]


def plain_terms(texts, threshold):
    """Every term against every entity of its document: the spans of kind term, document by document."""
    mask = lambda t: re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: " " * len(m.group()), t)
    terms = [[(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_][^\W_]+", mask(t))] for t in texts]
    held = [collections.defaultdict(set) for _ in texts]
    for i, t in enumerate(texts):
        mails = [(s, e) for k, s, e in plain_personal(t) if k == "email"]
        for (s, e), before, after in zip(mails, [(0, 0), *mails], [*mails[1:], (len(t), 0)], strict=False):
            held[i][t[s:e].lower()].add((t[before[1] : s][-120:], t[e : after[0]][:120]))
    n, n_term, n_entity, both, contexts = len(texts), collections.Counter(), collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for own, entities in zip(terms, held, strict=True):
        distinct = {w for w, _, _ in own}
        n_term.update(distinct)
        n_entity.update(entities.keys())
        for e, seen in entities.items():
            for w in distinct:
                both[w, e] += 1
                contexts[w, e] |= seen
    told = set()
    for (w, e), k in both.items():
        bits = np.log2(n * k / (n_term[w] * n_entity[e]))
        if k > 1 and len(contexts[w, e]) > 1 and bits >= threshold * np.log2(n / n_entity[e]) and k * bits > np.log2(n):
            told.add((w, e))
    return [[("term", s, x) for w, s, x in own if any((w, e) in told for e in entities)] for own, entities in zip(terms, held, strict=True)]


def test_terms_far_from_their_entity(documents):
    texts = [f"kestrel {i} " + "plain filler words " * 40 + f"mira@zoo.org said {i} and kestrel again" for i in range(5)] + ["plain filler words said and again"] * 60
    got = spans(sanitise.find(documents(texts)), None)
    marked = [{texts[i][s:e] for k, s, e in got[i] if k == "term"} for i in range(65)]
    assert all(m == {"kestrel"} for m in marked[:5]) and not any(marked[5:])
    assert all(sum(k == "term" for k, _, _ in got[i]) == 2 for i in range(5))


@pytest.mark.parametrize("common", [1000, 6])
def test_terms_against_every_pair(documents, monkeypatch, common):
    monkeypatch.setattr(sanitise, "_COMMON", common)
    rng = random.Random(5)
    words = [f"w{rng.randrange(300)}" for _ in range(40)] + [f"Zé{i}" for i in range(40)]
    texts = []
    for i in range(240):
        who = rng.randrange(12)
        own = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if i % 3:
            own += [f"u{who}@mail.example"] * rng.choice([1, 1, 2]) + [f"Nick{who}"] * (rng.random() < 0.8) + ["all@hot.example", "hotword"] * (i % 2)
        rng.shuffle(own)
        texts.append(" ".join(own))
    texts += [texts[1]] * 7 + ["", "solo@one.example unique unique solo@one.example", "a@b.cc,x4111111111111111 a@b.cc"]
    got = spans(sanitise.find(documents(texts)), None)
    want = plain_terms(texts, 0.9)
    assert {i: [x for x in got[i] if x[0] == "term"] for i in got} == dict(enumerate(want))
    assert sum(map(len, want)) > 100


def plain_secrets(text):
    rules = [
        ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m)]
    return [(name, s, e) for s, _, name, e in sorted(found)]


def test_secrets_base_spans(documents):
    assert spans(secret_scan.scan(documents(ODD)), "guess") == {i: plain_secrets(t or "") for i, t in enumerate(ODD)}


def test_guess_costs(documents):
    ranks = {w: i + 1 for i, w in enumerate(secret_scan.COMMON_WORDS)}
    cost = lambda v: secret_scan.guess_cost(v, ranks, 12)
    assert max(map(cost, ("password", "P4ssw0rd", "aaaaaaaaaaaa", "qwertyuiop", "12345678", "welcome2019", "abcabcabcabc"))) < 8 < min(map(cost, ("zQ9$kf81Lm2x", "t7Gq-Vw0Xr3k")))
    assert cost("x") < cost("xk") < cost("xkq9") and cost("") == 0
    got = secret_scan.scan(documents(["pwd := zQ9$kf81Lm2x.", "password: please", None])).collect()
    assert {r["key"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] == "guess"] for r in got} == {0: [("guess", 7, 19)], 1: [], 2: []}


def test_guess_values_are_whole(documents):
    cases = [('password: "correct horse battery staple"', "correct horse battery staple"), ('passphrase: "my dog ate 8 bones!"', "my dog ate 8 bones!"),
             (f"password{' ' * 12}=\t S3cr&t!xQz", "S3cr&t!xQz"), ('userPassword="zQ9$kf81Lm2x"', "zQ9$kf81Lm2x"), ("token = 'it is \"zQ9$kf81\" now'", 'it is "zQ9$kf81" now'),
             ('password: "zQ9$kf81Lm2x\nnext line"', "zQ9$kf81Lm2x"), ("compassword: zQ9$kf81Lm2x", None)]
    got = {r["key"]: [cases[r["key"]][0][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "guess"] for r in secret_scan.scan(documents([t for t, _ in cases])).collect()}
    assert got == {i: [v] if v else [] for i, (_, v) in enumerate(cases)}


WORDS_IN_USE = ["successful", "authentication", "administrator", "contrase\u00f1a", "erforderlich", "n\u00e9cessaire"]


def test_words_of_the_corpus_are_cheap(documents):
    """A word that other documents use is no secret; one seen only as a value, however often, is."""
    texts = [f"login: {w}" for w in WORDS_IN_USE] + ["this was " + " and ".join(WORDS_IN_USE)] * 2 + ["password: vkqzjwxbtrm"] * 3 + [f"token: {WORDS_IN_USE[0]}Zq7$kfLw2x", None, ""]
    got = {r["key"]: [texts[r["key"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "guess"] for r in secret_scan.scan(documents(texts)).collect()}
    want = {i: [] for i in range(len(texts))} | {8: ["vkqzjwxbtrm"], 9: ["vkqzjwxbtrm"], 10: ["vkqzjwxbtrm"], 11: ["successfulZq7$kfLw2x"]}
    assert got == want
    few = {r["key"] for r in secret_scan.scan(documents(texts[:6] + texts[8:])).collect() if any(s["kind"] == "guess" for s in r["spans"])}
    assert few == {0, 1, 2, 3, 4, 5, 6, 7, 8, 9}  # without the documents that use the words


def all_segmentations(value, ranks):
    """The cheapest of every way to cut a value into words and brute-force spans."""
    best = math.inf
    for cuts in range(1 << (len(value) - 1)):
        ends = [i + 1 for i in range(len(value) - 1) if cuts >> i & 1] + [len(value)]
        total = 0.0
        for start, end in zip([0, *ends], ends, strict=False):
            piece, forms = value[start:end], []
            low = piece.lower()
            for word, extra in ((low, 0.0), (low.translate(str.maketrans("013457@$!", "oieastasi")), 0.3)):
                if word in ranks and len(word) >= 3:
                    forms.append(math.log10(ranks[word] + 1) + extra + (0.3 if piece != low else 0))
                    break
            forms.append(sum(math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33) for c in piece))
            total += min(forms) + math.log10(2)
        best = min(best, total)
    return best


def test_guess_costs_against_every_segmentation():
    rng = random.Random(4)
    ranks = {"cat": 1, "kite": 5, "tea": 40, "rote": 900, "catkin": 30}
    for _ in range(150):
        value = "".join(rng.sample(["Kite", "t3a", "r0te", "catkin", "%", "x", "q", "8"], rng.randrange(1, 4)))[:11]  # no repeats, which are cheaper
        assert secret_scan.guess_cost(value, ranks, 6) == pytest.approx(all_segmentations(value, ranks)), value


def plain_measures(text):
    words = WORDS.findall(text)
    three = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if three[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_quality_measures(documents):
    got = {r["key"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in quality_rules.judge(documents(ODD)).collect()}
    want = {i: plain_measures(t or "") for i, t in enumerate(ODD)}
    assert got == {i: (*m, m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, m in want.items()}


def test_hosts_are_shrunk_and_rejected(documents):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short", "bad") for i in range(99)] + [(99, good, "bad"), (100, "short", "small"), (101, good, "small"), (102, good, None), (103, None, None)]
    rows += [(200 + i, good, f"h{i % 20}") for i in range(400)]
    df = documents(rows)
    kept = {r["key"]: r["kept"] for r in quality_rules.judge(df).collect()}
    assert not kept[99] and kept[101] and kept[102] and not kept[103] and all(kept[200 + i] for i in range(400))
    left = quality_rules.keep_good(df)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {k for k, v in kept.items() if v}
    rates = {r["host"]: r for r in quality_rules.host_rates(quality_rules.document_measures(df)).collect()}
    assert rates["small"]["shrunk_rate"] < rates["small"]["rate"] and rates["bad"]["shrunk_rate"] > 0.75


def test_further_rules_fail_documents_and_feed_hosts(documents):
    good = " ".join(f"word{i}" for i in range(60))
    bad = {1: good + " #" * 9, 2: "\n".join([good, *["one line"] * 5]), 3: " ".join("abcdefghi"[i % 9] for i in range(60)), 4: " ".join(f"{'x' * 12}{i}" for i in range(60))}
    rows = [(0, good, "h"), *((i, t, "h") for i, t in bad.items()), *((10 + i, good + " $%&|" * 4, "symbols") for i in range(90)), (200, good, "symbols")]
    rows += [(300 + i, good, f"h{i % 20}") for i in range(400)]
    got = {r["key"]: r for r in quality_rules.judge(documents(rows)).collect()}
    assert not got[1]["base_failed"] and not any(got[i]["kept"] for i in bad) and got[0]["kept"]
    assert not got[200]["base_failed"] and not got[200]["kept"] and got[300]["kept"]  # its host fails by symbols alone
    assert {r["doc_id"] for r in quality_rules.keep_good(documents(rows)).collect()} == {k for k, r in got.items() if r["kept"]}


def plain_jump(key, shards):
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at


def test_jump_hash():
    keys = np.random.default_rng(3).integers(0, 1 << 64, 3000, dtype=np.uint64)
    few, more = sharding.jump(keys, 24), sharding.jump(keys, 25)
    assert few.tolist() == [plain_jump(int(k), 24) for k in keys]
    assert set(more[more != few]) == {24} and 60 < (more != few).sum() < 190
    assert np.bincount(few, minlength=24).min() > 70


def test_shards(documents):
    rows = [(i, "x" * i, "s") for i in range(200)] + [(7, None, "s")] * 150
    got = sharding.assign_shards(documents(rows), 24, blocks=4).collect()
    assert len(got) == 350
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r["size"] in (r["key"] + 8, 8) and (r["size"] > 8 or r["text_crc32"] == 0) and r["grown_shard"] in (r["shard"], 24)
        assert r["text_crc32"] == zlib.crc32(b"x" * (r["size"] - 8))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r["shard"] for r in got if r["key"] == 7}) == 1


def test_packing(documents):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    rng = random.Random(5)
    texts = [*ODD, " " * 3000 + "x", "<|endoftext|> a"] + [" ".join(rng.choice(["the", "Zebra", "été", "12"]) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    got = packing.pack(documents([*texts, (0, None, "s")][:-1]), capacity=256, open_sequences=8, group_tokens=20000).collect()
    pieces, room = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for i, t in enumerate(texts):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        rows = sorted(pieces[i], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in rows] == [(k, s, n) for k, (s, n) in enumerate(packing.cut(len(ids), 256))]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in rows)
    for placed in room.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
    assert len(room) < 1.1 * total / 256 + 2


def test_best_fit_bins():
    bins = packing.OpenSequences(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4, 9, 9, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (3, 9)]
    bins = packing.OpenSequences(10, 2)  # the fullest of the two closes, so 2 fits in the emptier one
    assert [bins.put(n) for n in (8, 7, 9, 2)] == [(0, 0), (1, 0), (2, 0), (1, 7)]


@pytest.mark.parametrize("run", [sanitise.find, secret_scan.scan, quality_rules.judge, quality_rules.keep_good, packing.pack, lambda d: sharding.assign_shards(d, 24)])
def test_empty_table(documents, run):
    assert run(documents([(0, "x", "s")]).filter("false")).count() == 0
