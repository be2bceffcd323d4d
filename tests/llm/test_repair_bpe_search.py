"""Conversation repair, BPE with chunk reuse and ball-tree search against brute force and the library."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from regiostat.llm import bpe, conversation, lexical
from regiostat.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------- op11: repair
def audits(rows):
    """Every way to edit a short conversation: (cost, audit, repaired rows), by exhaustion."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    options = []
    for (role, text), fault in zip(rows, faults):
        more = 5 if fault == "cut" else 0
        own = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            own += [(more, "K", [(role, text)])] + [(1 + more, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append(own)
    for edits in itertools.product(*options):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for k, ins in enumerate(added):
                cost, audit, out = cost + 5 * len(ins), audit + "I" * len(ins), out + [(r, "") for r in ins]
                if k < len(edits):
                    c, letter, kept = edits[k]
                    cost, audit, out = cost + c, audit + letter, out + kept
            if best and cost > best[0]:
                continue
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                way = cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
                best = min(best, way) if best else way
    return best


def run(rows, **kw):
    conv = conversation.Conversation(conversation.Audits(**kw))
    conv.spare = 8  # nodes are freed all the time
    seen = set()
    for turn, (role, text) in enumerate(rows):
        conv.row(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    return conv.report()


ROLES = ["system", "user", "assistant", "tool", ""]


@pytest.mark.parametrize("base", [{}, {"base": 1, "prime": 7}])  # the second hash collides all the time
def test_audit_brute_force(base):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3):
        for _ in range(1 if not n else 60 if n < 3 else 25):
            rows = [(ROLES[rng.choice(5, p=[.2, .35, .3, .1, .05])], ["a.", "b", "", "c!"][rng.integers(4)]) for _ in range(n)]
            want = audits(rows)
            got = run(rows, **base)
            assert (got[5], got[6]) == want[:2], rows
            assert got[7] == hashlib.sha256(want[2].encode()).hexdigest(), rows


def plain_audit(rows):
    """The same dynamic program with whole strings in its states."""
    ways = {conversation.START: (0, "")}

    def insert(w):
        for target, sources in ((2, (0, 1, 3)), (3, (2,))):
            for q in sources:
                if q in w:
                    c = (w[q][0] + 5, w[q][1] + "I")
                    w[target] = min(w.get(target, c), c)
        return w

    insert(ways)
    seen = set()
    for role, text in rows:
        again, bare = (role, text) in seen, text.strip()
        seen.add((role, text))
        more = 5 if bare and not again and bare[-1] not in ".!?" else 0
        new = {}
        for q, (c, s) in ways.items():
            found = [(q, c + 2, "D")]
            if bare and not again:
                kept = conversation.KEPT.get(role[:1], {}).get(q)
                if kept is not None:
                    found.append((kept, c + more, "K"))
                found.append((conversation.NEXT[q][0], c + 1 + more, "R"))
            for p, cost, letter in found:
                new[p] = min(new.get(p, (cost, s + letter)), (cost, s + letter))
        ways = insert(new)
    return min(ways[q] for q in (0, 3) if q in ways)


@pytest.mark.parametrize("kw", [{}, {"base": 31, "prime": 101}])
def test_audit_long(kw):
    rng = np.random.default_rng(4)
    for kind in ("user", "mixed", "faults"):
        rows = []
        for i in range(700):
            role = "user" if kind == "user" else ROLES[rng.integers(5)]
            rows.append((role, f"text {i}" + "." * int(kind == "mixed" or rng.random() < .6)) if rng.random() < .9 else (role, " "))
        assert run(rows, **kw)[5:7] == plain_audit(rows)


def test_open_stretch_is_freed():
    conv = conversation.Conversation()
    conv.spare = 64
    for i in range(20_000):
        conv.row(i, ("user", "assistant")[i % 2], f"{i}.", False)
    assert len(conv.audits.parent) < 2 * conversation.SPARE and conv.report()[5:7] == (0, "K" * 20_000)


def test_state_bounds_hold():
    """No continuation is dearer from p than from q by more than ENOUGH[p][q]."""
    for n in range(4):
        for rows in itertools.product([(r, t) for r in ("system", "user", "assistant", "x") for t in ("a.", "a", "")], repeat=n):
            if n == 3 and hash(rows) % 7:
                continue

            def rest(state):
                ways = {state: 0}
                for k in range(n + 1):
                    for target, sources in ((2, (0, 1, 3)), (3, (2,)), (2, (3,))):
                        for q in sources:
                            if q in ways:
                                ways[target] = min(ways.get(target, 99), ways[q] + 5)
                    if k == n:
                        break
                    role, text = rows[k]
                    new = {}
                    for q, c in ways.items():
                        new[q] = min(new.get(q, 99), c + 2)
                        if text:
                            more = 0 if text.endswith(".") else 5
                            for p, d in ((conversation.KEPT.get(role[0], {}).get(q), 0), (conversation.NEXT[q][0], 1)):
                                if p is not None:
                                    new[p] = min(new.get(p, 99), c + d + more)
                    ways = new
                return min(c for q, c in ways.items() if q in (0, 3))

            cost = [rest(q) for q in range(4)]
            for p in range(4):
                for q in range(4):
                    assert cost[p] <= cost[q] + conversation.ENOUGH[p][q], (rows, p, q)


CONV = "conv_id long, turn long, role string, text string, live long, again string, copy int"
ODD_CONV = [
    (1, 1, "user", "Hi.", 1, "x", 1), (1, 1, "user", "Hi.", 1, "x", 1), (1, 2, "assistant", "Yes.", 0, None, 2),
    (2, None, None, None, None, None, None), (2, 5, "user", "A b", 1, "x", 1), (2, 9, "assistant", "?", 1, "x", 1),
    (None, 1, "user", "Null conv.", 1, "x", 1), (None, 2, "assistant", "Ok!", 1, "x", 1), (3, 1, "tool", "A.", 1, "x", 1),
    (4, 1, "", "", 1, "x", 1), (5, 7, "assistant", "Same turn.", 1, "x", 1), (5, 7, "user", "same turn?", 1, "x", 1),
    (6, 1, "user", "long " * 40_000 + ".", 1, "x", 1), (6, -3, "assistant", "Ünï ЖЖ.", 1, "x", 1),
] + [(7, i, ("user", "assistant")[i % 2], f"turn {i}.", 1, "x", 1) for i in range(60)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd-conv"))
    spark.createDataFrame(ODD_CONV, CONV).repartition(3).write.parquet(f"{path}/conversations.parquet")
    bench = [(1, "one two", "x"), (1, "one two", "x"), (2, None, None), (3, "", "x"), (None, "ЖЖ seven", "x"), (4, "zzz", "x"),
             (5, "one " * 5000, "x")]
    spark.createDataFrame(bench, "item_id long, text string, score string").write.parquet(f"{path}/benchmark.parquet")
    docs = [(1, "One two three", "x", 1), (1, "One two three", "x", 1), (None, "one TWO", "x", 1), (2, None, "x", 1), (3, " \t", "x", 1),
            (4, "ЖЖ Жж seven", None, 1), (5, "seven " * 30_000, "x", None), (6, "a" * 50_000, "x", 1), (7, "one-two_three", "x", 1),
            (8, "<|endoftext|> it's <|startoftext|>5 Ünḯ   x y", "x", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, ids string, rank int").repartition(2).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    for t in ("documents", "benchmark", "conversations"):
        spark.createDataFrame([], spark.read.parquet(f"{SMALL}/{t}.parquet").schema).write.parquet(f"{path}/{t}.parquet")
    return path


NEW = ["op11_conversation_repair", "op12_bpe_round_trip", "op13_lexical_search"]


@pytest.mark.parametrize("name", NEW)
def test_empty(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", [n for n in NEW if n in ORACLE])
def test_odd_against_sql(spark, odd, name):
    con = duck(SMALL)
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{odd}/{t}.parquet/*.parquet')")
    info = compare(spark, name, QUERIES[name], ORACLE[name], odd, con)
    assert "error" not in info and info["spark_rows"], info


@pytest.mark.parametrize("path", [SMALL, "odd"])
def test_repaired_rows(spark, odd, path):
    """The rows of repaired conversations have the digest that the report states."""
    path = odd if path == "odd" else path
    rows = conversation.damaged(spark.read.parquet(f"{path}/conversations.parquet"))
    report = conversation.repair(rows)
    parts = {}
    for r in conversation.repaired_rows(rows, report).collect():
        parts.setdefault(r.conv_id, {})[r.place] = f"{r.role}:{r.text}"
    for r in report.collect():
        own = parts.get(r.conv_id, {})
        assert sorted(own) == list(range(1, len(own) + 1))
        text = "\n".join(own[k] for k in sorted(own))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in text.split("\n") if x)) or "\n" in "".join(
            t.text or "" for t in rows.where(F.col("conv_id").eqNullSafe(r.conv_id)).collect())


def test_damage(spark, odd):
    for r in conversation.damaged(spark.read.parquet(f"{odd}/conversations.parquet")).collect():
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        fault = zlib.crc32(key.encode()) % 20
        assert r.live == (fault != 0)
        assert fault != 4 or r.role == "user"
        assert fault != 1 or r.text == ""
        assert fault != 2 or not set(".!?") & set(r.text)


# ---------------------------------------------------------------- op12: BPE
TEXT = st.lists(st.sampled_from(
    ["the ", "quick brown ", "it's ", "<|endoftext|>", "<|startoftext|> ", "\n", "\t", " ", "  ", "é", "é ", "Ω", "한글 ", "하",
     " ", " ", "　", "12 ", "!!?", "x" * 40, "İ ", "ﬁ", "\x0b", "\x1c", "'", "s ", "😀 ", "̈"]), max_size=60).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_chunks_give_the_library_tokens(text):
    """Recipes with very small chunks against the whole text's own tokens."""
    cutter = bpe._Cutter(bpe.VOCABULARY, bits=3, least=4)
    data = text.encode()
    chunks, (_, (parts,), words) = cutter.batch([1], [data])
    tokens = bpe.encoded(cutter.tok, [c.decode() for c in chunks.values()], cutter.kind)
    got = np.frombuffer(b"".join(tokens[p] if p >= 0 else words[-p - 1] for p in parts), cutter.kind)
    assert got.tolist() == cutter.tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_give_the_library_tokens(text):
    tok = bpe.tokenizer(bpe.VOCABULARY)
    kind = bpe.id_type(tok)
    got = bpe.Words(tok, kind, most=5).tokens([text.encode(), b"", text.encode()])
    want = np.array(tok.encode(text, add_special_tokens=False).ids, kind).tobytes()
    assert got == [want, b"", want]


PARTS = st.lists(st.sampled_from(
    [" ", "\n", "\x0c", "\x1c", "\x85", "\xa0", "Ab", "Éa", "ñ", "ß", "Ÿ", "ŉ", "ſ", "İ", "ı", "×", "÷", "Ж", "한", "̇", "́", "ǆ", ",", "...",
     "'s", "'S", "'", "7", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "\x00", "ª", "²", "-", "’"]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=4))
def test_parted_words_give_the_library_tokens(texts):
    tok = bpe.tokenizer(bpe.VOCABULARY)
    kind = bpe.id_type(tok)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    got = bpe.Words(tok, kind).tokens([t.encode() for t in texts])
    assert [np.frombuffer(x, kind).tolist() for x in got] == want
    assert [tok.encode(bpe.parted(t.encode()).decode(), add_special_tokens=False).ids for t in texts] == want


def test_parted():
    assert bpe.parted("Écoles, it's ABC×D İa, Ab7 AbЖ, <|endoftext|>x A<|ENDOFTEXT|>".encode()).decode() == \
        "Écoles , it 's ABC×D İa, ab 7 AbЖ, <|endoftext|>x a <|ENDOFTEXT|>"
    assert bpe.parted(b"") == b"" and bpe.parted(b"A") == b"a" and bpe.parted(b"\xc3") == b"\xc3" and bpe.parted(b"a\xc3 B.") == b"a\xc3 b ."


def test_letters_of_words_are_encoded_once(monkeypatch):
    """Words that differ in case of ASCII letters or in what follows the letters ask the library once for them."""
    tok = bpe.tokenizer(bpe.VOCABULARY)
    asked = Counter()
    plain = bpe.encoded
    monkeypatch.setattr(bpe, "encoded", lambda tok, texts, kind: asked.update(
        w for t in texts for w in t.replace(bpe.separator(tok)[0], " ").split()) or plain(tok, texts, kind))
    text = "stone, Stone. STONE!! stone### (stone) éaireç éaireç, éaireç.".encode()
    words = bpe.Words(tok, bpe.id_type(tok))
    words.tokens([text])
    words.tokens([text])
    assert asked == Counter(["stone", "éaireç", ",", ".", "!!", "###", "(stone)"])


def test_other_vocabularies_are_not_parted():
    import tokenizers
    same = tokenizers.Tokenizer.from_str(bpe.tokenizer(bpe.VOCABULARY).to_str())
    assert bpe.parts_letters(same)
    same.normalizer = tokenizers.normalizers.NFC()  # tells cases apart
    assert not bpe.parts_letters(same)
    assert not bpe.parts_letters(tokenizers.Tokenizer(tokenizers.models.BPE()))


def test_tokens_by_rank():
    rng = np.random.default_rng(0)
    order = rng.permutation(49408).astype(np.int32)
    ranks = np.empty_like(order)
    ranks[order] = np.arange(len(order))
    kind = np.dtype("<u2")
    parts = [order[rng.integers(0, top, n)].astype(kind).tobytes() for top, n in ((5, 100), (49408, 1000), (4080, 300), (241, 0), (1, 1))]
    parts.append(order[[0, 239, 240, 4079, 4080, 49407]].astype(kind).tobytes())
    assert bpe.from_ranks(bpe.by_rank(parts, kind, ranks), kind, order) == parts
    assert bpe.from_ranks(bpe.by_rank([], kind, ranks), kind, order) == []


@given(st.lists(st.binary(max_size=50), max_size=20))
def test_packed(parts):
    assert bpe.unpacked(bpe.packed(parts)) == parts


def test_cuts_follow_content():
    rng = np.random.default_rng(1)
    body = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(4000)).encode()
    one, two = bpe.joins(body), bpe.joins(b"another beginning " + body)
    same = {body[a:d] for a, _, _, d in one} & {(b"another beginning " + body)[a:d] for a, _, _, d in two}
    assert len(one) > 20 and len(same) >= len(one) - 1
    # the rolling hash of each place, plainly
    data = np.frombuffer(body[:300], np.uint8)
    gear = bpe._GEAR.tolist()
    plain = [sum(gear[data[i - j]] << j for j in range(min(32, i + 1))) % (1 << 64) for i in range(300)]
    want, last = [], 0
    for i, h in enumerate(plain):
        if h >> 61 == 0 and i + 1 - last >= 5 and 300 - i - 1 >= 5:
            want.append(i + 1)
            last = i + 1
    assert bpe.cuts(data, 3, 5) == want


def library(texts):
    tok = bpe.tokenizer(bpe.VOCABULARY)
    out = []
    for t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("path", [SMALL, "odd"])
def test_bpe_is_the_library(spark, odd, path):
    path = odd if path == "odd" else path
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, library([r.text for r in rows])))
    got = QUERIES["op12_bpe_round_trip"](spark, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_chunks_are_encoded_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    asked = bpe.asked_chunks(docs.unionByName(docs).repartition(6), bits=7, least=32).where("bucket IS NOT NULL")
    own, every, of = set(), [], {}
    for r in asked.collect():
        parts = bpe.unpacked(bytes(r.body))
        assert all(hashlib.blake2b(t, digest_size=16).digest() == d for d, t in zip(parts[::2], parts[1::2]))
        for d in parts[::2]:
            assert (r.batch, d) not in own  # a batch asks once
            own.add((r.batch, d))
            every.append(d)
            assert of.setdefault(d, r.bucket) == r.bucket  # a chunk has one bucket
    assert len(set(every)) < len(every) * 0.8  # batches ask for the same chunks


@pytest.mark.parametrize("bucket_bytes", [1 << 14])
def test_many_buckets_give_the_same(spark, bucket_bytes):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before, bpe.BUCKET_BYTES = bpe.BUCKET_BYTES, bucket_bytes
    try:
        many = bpe.encode(docs.repartition(5)).collect()
    finally:
        bpe.BUCKET_BYTES = before
    tok = bpe.tokenizer(bpe.VOCABULARY)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.ids for r in many} == {d: tok.encode(t or "", add_special_tokens=False).ids for d, t in texts.items()}


# -------------------------------------------------------------- op13: search
def some_docs(rng, n, words=400):
    p = 1 / np.arange(1, words + 1)
    p /= p.sum()
    docs = []
    for i in range(n):
        if docs and rng.random() < .3:  # near copies
            t = list(docs[rng.integers(len(docs))])
            t[rng.integers(len(t))] = rng.integers(words)
        else:
            t = rng.choice(words, rng.integers(1, 60), p=p).tolist()
        docs.append(t)
    return [" ".join(f"w{x}" for x in t) for t in docs]


def test_ball_tree_brute_force():
    rng = np.random.default_rng(8)
    docs = [Counter(lexical.terms(t)) for t in some_docs(rng, 900)]
    names = sorted({t for d in docs for t in d})
    place = {t: i for i, t in enumerate(names)}
    w = np.array([lexical.weight(len(docs), sum(t in d for d in docs)) for t in names], np.int64)
    at = np.r_[0, np.cumsum([len(d) for d in docs])]
    term = np.array([place[t] for d in docs for t in sorted(d)], np.int32)
    value = np.array([10**9 * d[t] // (1000 * d[t] + 8 * (10 + sum(d.values()))) for d in docs for t in sorted(d)], np.int32)
    tree = lexical.BallTree(lexical.Rows(at, term, value), np.sqrt(w.astype(float)), leaf=16)
    assert sorted(tree.order.tolist()) == list(range(900))
    root, rank = np.sqrt(w.astype(float)), np.arange(900)
    for _ in range(40):
        q = np.unique(rng.choice(len(names), 12)).astype(np.int64)
        dense = np.zeros(len(names), np.int64)
        dense[q] = w[q]
        exact = np.array([int(sum(dense[term[i]] * int(value[i]) for i in range(at[r], at[r + 1]))) for r in tree.order])
        bound = tree.bounds(q, w[q], root)
        for node in range(len(tree.start)):
            assert exact[tree.start[node]:tree.end[node]].max() <= bound[node]
        want = sorted(((int(s), -r) for r, s in enumerate(exact) if s > 0), reverse=True)[:10]
        for floor in (1, want[-1][0]):
            got = tree.search(q, w[q], root, dense, rank, 10, floor)
            assert sorted(((s, -r) for s, r in got), reverse=True) == want


def test_search_in_groups_and_blocks(spark):
    """Small blocks, item groups of few terms and the floor of the first round change nothing."""
    con = duck(SMALL)
    want = con.execute(ORACLE["op13_lexical_search"]).fetchall()
    items, docs = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("benchmark", "documents"))
    for kw in ({"block": 16, "most": 500}, {"block": 64, "leaf_round": False}):
        got = [tuple(r) for r in lexical.ranked(items, docs, **kw).collect()]
        assert sorted(got) == sorted(want)


def test_terms():
    pattern = "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    for t in ("", "A-b_c\x00d\x7fE é Ж x 1.5", "`[]^@", "ÀB c", "\x80\x85z"):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        assert [x.decode() for x in lexical.terms(t)] == re.findall(pattern, lower)
