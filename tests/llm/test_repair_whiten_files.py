"""Conversation repair, whitening and token files against plain Python and numpy."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emberlog.llm import conversations, queries, token_files, whitening

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CONVERSATIONS = "conv_id long, turn long, role string, text string"
CLASHES = ["conv", "key", "kind", "part", "block", "audit", "row", "at", "x", "id", "ids", "tie", "piece", "start"]


def with_clashes(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHES))


# 11: conversation repair


def damaged_rows(conv, rows):
    """[(turn, role, text)] of one conversation after damage, in order."""
    out = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        said = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(said.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    key = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, key(r)))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def edited(rows, faults, limit=None):
    """(cost, audit) by strings: every state keeps its cheapest audit; with `limit`, all edit strings are tried instead."""
    if limit:
        best = None
        choices = []
        for f in faults:
            choices.append([p + c for p in ("", "I", "II") for c in ("D" if f in ("blank", "duplicate") else "DKua")])
        for way in itertools.product(*choices, ("", "I", "II")):
            for inserts in itertools.product("ua", repeat="".join(way).count("I")):
                roles, cost, left = "", 0, iter(inserts)
                for k, part in enumerate(way):
                    for c in part:
                        if c == "I":
                            roles, cost = roles + next(left), cost + 3
                        elif c == "D":
                            cost += 4
                        else:
                            cost += 3 * (faults[k] == "truncated") + 3 * (c != "K")
                            roles += c if c != "K" else rows[k][1][:1] if rows[k][1][:1] in ("s", "u", "a") else "x"
                if re.fullmatch("(s?(ua)+)?", roles):
                    best = min(best or (cost + 1, ""), (cost, re.sub("[ua]", "R", "".join(way))))
        return best
    ways = {"": (0, "")}
    put = lambda new, s, v: new.__setitem__(s, min(new.get(s, v), v))

    def insert(ways):
        for _ in range(2):
            new = dict(ways)
            for s, (cost, audit) in ways.items():
                put(new, "a" if s == "u" else "u", (cost + 3, audit + "I"))
            ways = new
        return ways

    for (_, role, _), fault in zip(rows, faults):
        new = {}
        for s, (cost, audit) in insert(ways).items():
            put(new, s, (cost + 4, audit + "D"))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                following = {"": "su", "s": "u", "u": "a", "a": "u"}[s]
                if role[:1] and role[:1] in following:
                    put(new, role[:1], (cost + more, audit + "K"))
                put(new, following[-1], (cost + more + 3, audit + "R"))
        ways = new
    ways = insert(ways)
    return min(v for s, v in ways.items() if s in ("", "a"))


def repaired_lines(rows, audit):
    lines, left = [], iter(rows)
    for edit in audit:
        role = "assistant" if lines and lines[-1][:1] == "u" else "user"
        if edit == "I":
            lines.append(f"{role}:")
            continue
        _, own, text = next(left)
        if edit != "D":
            lines.append(f"{own if edit == 'K' else role}:{text}")
    return "\n".join(lines)


def repair_by_hand(conv, rows):
    rows = damaged_rows(conv, rows)
    faults = faults_of(rows)
    turns = {r[0] for r in rows} - {None}
    cost, audit = edited(rows, faults)
    pairs = zip(rows, rows[1:])
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256(repaired_lines(rows, audit).encode()).hexdigest(),
    )


REPAIRED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def expected(rows):
    by = defaultdict(list)
    for conv, *row in rows:
        by[conv].append(row)
    return {conv: repair_by_hand(conv, rows) for conv, rows in by.items()}


def got(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r[c] for c in REPAIRED) for r in rows}
    assert len(found) == len(rows)
    return found


def odd_conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No", "Why?", "", " \t", None, "Fine!\n", "x" * 150_000 + ".", "And so on", "Ja. "]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "unknown"]
    rows = [(conv, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for conv in [None, *range(40)] for _ in range(rng.randint(1, 7))]
    rows += [(100, k, rng.choice(roles[:2]), rng.choice(texts[:4] + [f"t{k}."])) for k in range(400)]  # a long one
    rows += [(101, 3, "user", "the same.")] * 90 + [(102, 5, None, None)]
    return rows + rows[:3]


def test_conversations_of_the_table(spark, sf_dir):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet'").fetchall()
    assert got(queries.op11_persistent_audit(spark, sf_dir)) == expected(rows)


@pytest.mark.parametrize("partitions", [1, 7, 50])
def test_odd_conversations(spark, partitions):
    """Nulls in any column, ties, repeated rows, long texts, one conversation over many tasks and blocks."""
    rows = odd_conversations()
    df = with_clashes(spark.createDataFrame(rows, CONVERSATIONS))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(conversations.repair(df, block_rows=16)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert conversations.repair(df.where("false")).count() == 0


def test_conversation_whose_rows_all_go(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(7, turn, "user", "Gone.")], CONVERSATIONS)
    assert got(conversations.repair(df)) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def solve(rows, faults, size=1000):
    ways = conversations.begun(conversations.NONE)
    for at in range(0, len(rows), size):
        block = conversations.Block(range(4))
        for (_, role, _), fault in zip(rows[at : at + size], faults[at : at + size]):
            role = role[:1] if role[:1] in ("s", "u", "a") else "x"
            block.add(role, fault in ("blank", "duplicate"), fault == "truncated", 1)
        ways = conversations.joined(ways, block.entries())
    return conversations.finished(ways)


def test_cheapest_edits_are_those_of_all_edit_strings():
    faults = ["", "blank", "truncated"]
    for n in range(3):
        for roles in itertools.product(["system", "user", "assistant", "tool"], repeat=n):
            for f in itertools.product(faults, repeat=n):
                rows = [(0, r, "x") for r in roles]
                assert solve(rows, f) == edited(rows, f, limit=True) == edited(rows, f)


def test_blocks_of_any_size_give_the_same_edits():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(0, rng.choice(["system", "user", "assistant", "tool"]), "x") for _ in range(rng.randint(1, 40))]
        faults = [rng.choice(["", "", "truncated", "blank"]) for _ in rows]
        want = edited(rows, faults)
        assert [solve(rows, faults, size) for size in (1, 3, 1000)] == [want] * 3


def test_edits_compare_like_their_strings(monkeypatch):
    rng = random.Random(4)
    for hashed in (conversations._hash, lambda text: 0):  # the second makes every comparison a collision
        monkeypatch.setattr(conversations, "_hash", hashed)
        nodes = [conversations.ROOT]
        for _ in range(300):
            nodes.append(conversations.Edits(rng.choice(nodes[-20:]), rng.choice(["D", "I", "K", "R", "DD", "KR"])))
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert conversations.less(a, b) == (str(a) < str(b))


# 12: whitening


def test_whitening_of_the_table(spark, sf_dir):
    rows = queries.op12_block_whitening(spark, sf_dir).collect()
    table = dict(duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall())
    check_whitened(rows, table, 32)


def check_whitened(rows, table, most):
    x = {k: np.floor(64 * np.array(v, dtype=np.float64)).astype(np.int64) + 1_000_000 for k, v in table.items()}
    m = np.array(list(x.values()))
    n, s = len(m), m.sum(0)
    centred = m - s / n
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    k = min(most, m.shape[1])
    assert len(rows) == n * k
    z = defaultdict(lambda: np.zeros(k))
    for r in rows:
        z[r["vec_id"]][r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[r["vec_id"]], s))
        assert abs(r["explained"] - e[r["component"] - 1] / np.trace(v)) <= 1e-9
        assert 0 <= r["identity_error"] < 1e-9
    assert z.keys() == table.keys()
    for c in range(k):
        want = centred @ w[:, c] / np.sqrt(e[c])
        have = np.array([z[key][c] for key in x])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6
    whole = np.array([z[key] for key in x])
    assert np.abs(whole.T @ whole / n - np.eye(k)).max() < 1e-9


VECTORS = "vec_id long, embedding array<float>, label int"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(12)
    rows = [(k, [float(c) for c in rng.normal(size=5) * [1, 2, 3, 4, 50]], None) for k in range(300)]
    bad = [(900, None, 1), (901, [1.0, None, 2.0, 3.0, 4.0], 1), (902, [1.0, float("nan"), 2.0, 3.0, 4.0], 1), (903, [float("inf")] * 5, 1), (904, [], 1), (905, [1.0], 1)]
    df = with_clashes(spark.createDataFrame(rows + bad, VECTORS))
    for size in (7, 100, 4096):
        check_whitened(whitening.whiten(df, size=size).collect(), {r[0]: r[1] for r in rows}, 32)
    assert whitening.whiten(df.where("false")).count() == 0
    assert whitening.whiten(df.where("vec_id >= 900 and vec_id < 904")).count() == 0


def test_whitening_of_repeated_and_constant_rows(spark):
    rows = [(None, [1.0, 2.0], 0)] * 50 + [(1, [3.0, 2.0], 0)] * 50
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 200 and {r["identity_error"] for r in got} == {0.0}
    assert {(r["component"], round(abs(r["whitened"]), 9), r["explained"]) for r in got} == {(1, 1.0, 1.0), (2, 0.0, 0.0)}
    one = whitening.whiten(spark.createDataFrame([(5, [1.0, 2.0], 0)], VECTORS)).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(5, 1, 1, 0, 0.0, 0.0), (5, 2, 1, 0, 0.0, 0.0)]
    far = whitening.whiten(spark.createDataFrame([(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0)], VECTORS)).collect()
    assert len(far) == 4 and {r["deviation"] for r in far} == {None}


def test_sums_and_deviations_are_exact():
    x = np.array([[1 << 52, 5], [-(1 << 52), 7], [3, 9]], dtype=np.int64)
    assert whitening.deviations(x, 3, [3, 21]) == [None, None, (9 - 3) ** 2 + (27 - 21) ** 2]
    assert whitening.deviations(np.array([[1000064, 999936]]), 10, [10_000_000, 10_000_000]) == [2 * 640**2]


# 13: token files


def check_files(got, docs):
    """`got` rows against the library's ids of (doc_id, text) in order."""
    tok = token_files.tokenizer(WORD_BPE)
    want, at, every = [], 0, []
    for doc, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
        every += ids.tolist()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    return every


def test_token_files_of_the_table(spark, sf_dir):
    docs = sorted(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    check_files(queries.op13_rans_token_files(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect(), docs)


ODD_TEXTS = [
    None, "", " ", "word", "The END, (really?) \"yes\" it's I'll don't", "Straße ÉCOLE École é é İstanbul ŒUVRE ǅ", "<|endoftext|> a<|startoftext|>b <|endoftext|>",
    "one two three four five six seven eight nine ten " * 3000, "x" * 3000, "1234 56.78 a1b2 #tag --- ...", "tab\tnew\nline　wide\x1codd\x00nul", "日本語 текст ελληνικά 🙂🙂", "-", "''s", "*bold*",
]


def test_token_files_of_odd_rows(spark, tmp_path):
    """Nulls, special strings, long texts, repeated rows; documents cut into pieces over blocks, parts and checkpoints."""
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (7, ODD_TEXTS[7]), (7, ODD_TEXTS[7])]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    order = [(None, "no id")] + [r for k in range(len(ODD_TEXTS)) for r in rows if r[0] == k]
    for n, options in enumerate(({}, {"piece": 100, "block": 1000, "lanes": 8, "checkpoint": 200})):
        folder = str(tmp_path / f"files{n}")
        token_files.write_token_files(df, WORD_BPE, folder, 1, **options)
        every = check_files(token_files.read_token_files(spark, folder).collect(), order)
        for first, stop in ((0, 10), (4321, 9876), (len(every) - 3, len(every) + 5)):
            parts = token_files.read_ids(spark, folder, first, stop).orderBy("at").collect()
            assert [i for r in parts for i in r["ids"]] == every[first:stop]
    token_files.write_token_files(df.where("false"), WORD_BPE, str(tmp_path / "empty"), 1)
    assert token_files.read_token_files(spark, str(tmp_path / "empty")).count() == 0


MIXED = [
    "ab", "Don't", "'S", "''s", "É", "e\u0301", "ß", "ẞ", "Ÿ", "×", "12", "²", "ª", "¿", "–", "‘x’", "…", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\x00",
    "<|endoftext|>", "日本", "Σας", "🙂", "K", "İ", "_", "[", "\\", "^", "-", "«»", "'ve",
]


def test_ids_of_mixed_texts_are_the_librarys():
    rng = random.Random(13)
    texts = [None, "", " ", *("".join(rng.choices(rng.sample(MIXED, rng.randint(1, 9)), k=rng.randint(1, 14))) for _ in range(6000))]
    for path, width in ((WORD_BPE, 2), (WORD_BPE, 4)):
        ids = token_files.TextIds(path, width)
        ids.runs.limit = ids.words.limit = 20  # full all the time
        at = 0
        while at < len(texts):
            some = texts[at : at + rng.choice([1, 2, 700])]
            at += len(some)
            for text, got in zip(some, ids.of(pa.array(some)), strict=True):
                assert got.tolist() == ids.tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_plain_texts_are_encoded_run_by_run_not_word_by_word():
    """Capitals and punctuation make new words, not new runs: what is looked up is bounded by the distinct runs of a slice."""
    ids, asked = token_files.TextIds(WORD_BPE, 2), []
    ids.runs.make = lambda run: asked.append(run) or ids.of_run(run)
    texts = [f"{a}{word}{b}" for a in ("", "(", '"', "¿") for word in ("house", "House", "HOUSE", "straße", "STRAßE") for b in ("", ".", ",", "?!")]
    assert [x.tolist() for x in ids.of(pa.array(texts))] == [ids.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    runs = ["", '"', "(", ",", ".", "?!", "house", "straße", "¿"]  # an empty one at the ends of texts
    assert sorted(asked) == runs and not ids.words
    ids.of(pa.array(["The house \u200b, the (House) 1\u0301"]))
    assert sorted(asked) == sorted([*runs, "the", ")"]) and {"\u200b,", "1\u0301"} <= set(ids.words)


def test_frequent_runs_outlast_a_full_memo():
    made = []
    memo = token_files.Recent(lambda key: made.append(key) or str(key), 10)
    for k in range(100):
        assert memo[k] == str(k) and memo["often"] == "often"
        assert len(memo) <= 10 and len(memo.aside) <= 10
    assert made.count("often") == 1 and len(made) == 101


def some_table(ids):
    counts = np.bincount(ids)
    some = np.flatnonzero(counts)
    return token_files.Table.of_counts(some.tolist(), counts[some].tolist())


@pytest.mark.parametrize("n", [1, 2, 63, 64, 1000, 50_001])
def test_blocks_come_back_from_any_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 3000).astype(np.uint32)
    table = some_table(ids)
    data = token_files.encode_block(ids, table, 32, 4096)
    assert (token_files.decode_block(data, table) == ids).all()
    for _ in range(20):
        first, stop = sorted(rng.integers(0, n + 1, 2))
        assert (token_files.decode_block(data, table, int(first), int(stop)) == ids[first:stop]).all()


def test_files_are_about_as_small_as_their_entropy():
    ids = (np.random.default_rng(2).zipf(1.2, 1 << 20) % 49_000).astype(np.uint32)
    p = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    bits = 8 * len(token_files.encode_block(ids, some_table(ids))) / len(ids)
    assert bits < 1.05 * -(p * np.log2(p)).sum()


def test_damaged_blocks_and_foreign_tables_are_refused():
    ids = np.arange(500, dtype=np.uint32) % 7
    table = some_table(ids)
    data = bytearray(token_files.encode_block(ids, table))
    with pytest.raises(ValueError, match="another table"):
        token_files.decode_block(bytes(data), some_table(ids[:400]))
    data[100] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        token_files.decode_block(bytes(data), table)


def test_checksums_join():
    rng = random.Random(1)
    for n in (0, 1, 5, 4096, 70_001):
        a, b = rng.randbytes(100), rng.randbytes(n)
        assert token_files.crc32_joined(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_tables_keep_every_id_and_sum_to_a_power_of_two():
    table = token_files.Table.of_counts(list(range(60_000)), [1] * 59_999 + [10**15])
    assert int(table.freq.min()) >= 1 and int(table.freq.sum()) == 1 << table.bits == 1 << 20
