"""The pipeline's stages on tables with clashing names, repeated rows, null ids and no labels."""

import base64
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regiostat.llm import near_dup, packing, secret_scan
from regiostat.llm.common import free_name

STAGES = dict(corpus_pipeline.STAGES)
SMALL = "/root/testdata/sf0.001"
CLASHING = ["gone", "__taken", "__row", "__language", "__spans", "dup_key", "DUP_GONE", "mix_row", "mix_taken", "language"]


def test_free_name():
    assert free_name(["a", "B"], "b") == "b_" and free_name(["x", "x_"], "x") == "x__" and free_name([], "x") == "x"


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    return docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASHING})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_extra_columns_come_back(spark, clashing, name):
    out = STAGES[name](spark, clashing, SMALL)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c}-{r.doc_id}" for c in CLASHING)


def test_repeated_rows_and_null_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")  # whose exact copies are counted once
    docs = docs.groupBy("text").agg(*[F.min(c).alias(c) for c in docs.columns if c != "text"])
    alone = sorted(r.text for r in STAGES["near_dedup"](spark, docs, SMALL).collect())
    twice = [r.text for r in STAGES["near_dedup"](spark, docs.unionByName(docs), SMALL).collect()]
    assert len(set(twice)) == len(twice) == len(alone)  # which copy of a group stays may differ
    without = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    got = STAGES["near_dedup"](spark, without.unionByName(without), SMALL).collect()
    assert Counter(Counter(r.text for r in got).values()) == {1: len(got)} and len(got) == len(alone)
    mixed = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    got = STAGES["near_dedup"](spark, mixed, SMALL).collect()
    assert sorted(r.text for r in got) == alone and all(r.doc_id is not None for r in got)


def test_no_labels(spark):
    rows = [(i, "12 34 --" if i % 2 else "some words", None, "a", 8) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in STAGES["language_id"](spark, docs, SMALL).collect()}
    assert got == set(range(0, 20, 2))


def test_redaction_in_one_pass(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    one = secret_scan.without_secrets(docs)
    two = secret_scan.redact(secret_scan.find_secrets(docs)).select("doc_id", "text")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


# ------------------------------------------------------- shapes of secrets
def der(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


def b64(data):
    return base64.b64encode(data).decode()


def lines(text, width=64, end="\n"):
    return end.join(text[i:i + width] for i in range(0, len(text), width))


NUMBER = der(2, b"\1" * 128)
RSA = der(0x30, der(2, b"\0") + NUMBER + b"".join(der(2, bytes([i + 1]) * 40) for i in range(7)))
DSA = der(0x30, der(2, b"\0") + NUMBER * 5)
PBES2 = bytes.fromhex("2a864886f70d01050d")
ENCRYPTED = der(0x30, der(0x30, der(6, PBES2) + der(0x30, b"")) + der(4, b"e" * 200))
EC = der(0x30, der(2, b"\1") + der(4, b"k" * 32) + der(0xA0, der(6, b"*\x86H\xce=\3\1\7")))


def part(b):
    return len(b).to_bytes(4, "big") + b


SSH = secret_scan.SSH_MAGIC + part(b"none") * 2 + part(b"") + (1).to_bytes(4, "big") + part(b"k" * 40) + part(b"s" * 90)


def url(x):
    return base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")


JWT = f"{url({'alg': 'HS256'})}.{url({'sub': 1})}.c2lnbmF0dXJl"


def pem(label, data, headers=""):
    return f"-----BEGIN {label}PRIVATE KEY-----\n{headers}{lines(b64(data))}\n-----END {label}PRIVATE KEY-----"


SEALED = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
FOUND = {
    "token after a word and a dot": (f"access-token.{JWT} x", "jwt", JWT),
    "token after a dash": (f"key-{JWT} x", "jwt", JWT),
    "DSA": (pem("DSA ", DSA), "pem", None),
    "encrypted PKCS 8": (pem("ENCRYPTED ", ENCRYPTED), "pem", None),
    "headers": (pem("RSA ", b"c" * 608, SEALED), "pem", None),
    "headers, escaped lines": (pem("RSA ", b"c" * 608, SEALED).replace("\n", "\\n"), "pem", None),
    "wrapped without marks": (f"here:\n{lines(b64(RSA))}\nend of it", "der", lines(b64(RSA))),
    "wrapped, windows lines, indented": ("  " + lines(b64(RSA), 60, "\r\n  "), "der", lines(b64(RSA), 60, "\r\n  ")),
    "after a path": (f"https://a.b/key/{b64(RSA)}", "der", b64(RSA)),
    "before other characters": (f"{b64(RSA).rstrip('=')}" + "ABCD" * 9 if len(RSA) % 3 == 0 else f"x/{b64(RSA)} y", "der", b64(RSA)),
    "short EC": (f"key=/{b64(EC)};", "der", b64(EC)),
    "SSH after a path": (f"/x/{b64(SSH)}", "ssh", b64(SSH)),
    "SSH wrapped": (lines(b64(SSH), 70), "ssh", lines(b64(SSH), 70)),
    "url alphabet": (f"a_{base64.urlsafe_b64encode(RSA).decode()}", "der", base64.urlsafe_b64encode(RSA).decode()),
}


@pytest.mark.parametrize("case", FOUND)
def test_shape_is_found(case):
    text, kind, key = FOUND[case]
    got = [(a, b) for k, a, b in secret_scan.spans_of(text) if k == kind]
    assert len(got) == 1, secret_scan.spans_of(text)
    assert text[slice(*got[0])] == (key or text)
    masked = secret_scan.mask(text, [s[1:] for s in secret_scan.spans_of(text)])
    body = (key or b64(DSA))[20:60]
    assert body not in masked


@pytest.mark.parametrize("text", [
    f"access.{url({'no': 1})}.{url({'sub': 1})}.c2ln", "a.b.c.d.e.f.g.h" * 9, pem("DSA ", DSA[:-1]), pem("DSA ", der(0x30, der(2, b"\1") + NUMBER * 5)),
    pem("ENCRYPTED ", der(0x30, der(0x30, der(6, b"`\x86H\1e\3\4\2\1") + der(5, b"")) + der(4, b"h" * 32))),  # a digest's shape
    pem("RSA ", b"c" * 609, SEALED), pem("RSA ", b"c" * 608, "Comment: mine\n\n"), f"/key/{b64(RSA)[:-9]}", f"/key/{b64(RSA)[:200]}\n\n{b64(RSA)[200:]}",
    "MI" + "A" * 400, "MIIB" * 300, "MHcC" * 100, f"x/{b64(SSH)[:-4]}", "M" * 5000, b64(der(0x30, NUMBER * 3))])
def test_near_miss_stays_out(text):
    assert [s for s in secret_scan.spans_of(text) if s[0] in ("pem", "jwt", "der", "ssh")] == []


def test_scan_is_linear():
    import time
    for text in ("MIIB" * 100_000, "a." * 200_000, "b3BlbnNzaC1rZXktdjEA" * 5_000, "MHcC\n" * 60_000, "eyJ" * 100_000 + ".a.b"):
        t = time.process_time()
        secret_scan.spans_of(text)
        assert time.process_time() - t < 5, text[:20]


def test_near_duplicates_as_clusters(spark):
    """Packed with the components of the near-duplicates, no bin holds two documents of one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    parts = near_dup.near_duplicates(docs).select(F.col("doc_id").alias("d"), F.col("component_id").alias("component"))
    rows = docs.join(parts, F.col("doc_id") == F.col("d")).drop("d")
    of = {r.doc_id: r.component for r in rows.select("doc_id", "component").collect()}
    held = {}
    for r in packing.pack(rows, cluster="component").collect():
        held.setdefault(r.bin_id, []).append(of[r.doc_id])
    assert len(set(of.values())) < len(of)
    assert all(len(set(b)) == len(b) for b in held.values())
