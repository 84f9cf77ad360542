"""Registered queries whole: their digests, from the tables, by plain Python."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tierkit.llm import queries

SMALL = "/root/testdata/sf0.001"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def test_op2_turns_and_loss_of_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    marks = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", marks), (-1, 1, "assistant", marks)]
    got = {r["conv_id"]: r for r in queries.op2_chat_formatting(spark, SMALL).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted((t, role, text or "") for c, t, role, text in rows if c == conv)
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == sha("".join(f"{role}\n{x}\n" for _, role, x in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
        assert r["formatted_chars"] > sum(len(x) for _, _, x in turns)


def test_op4_ids_and_bytes_of_all_documents(spark, docs):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op4_byte_bpe(spark, SMALL).collect()}
    for i, text in docs.items():
        ids = library.encode_ordinary(text)
        assert got[i] == (len(ids), sha(" ".join(map(str, ids))), sha(text))
    assert len(got) == len(docs)


def test_op5_sizes_law_and_slots(spark, docs):
    rows = queries.op5_hypergeometric_shards(spark, SMALL).collect()
    assert len(rows) == len(docs) and {r["law"] for r in rows} == {"rows"} and all(r["grown_shard"] is None for r in rows)
    slots = {}
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(8)]
    assert max(counts) - min(counts) <= 1


def test_op6_folds_and_predictions(spark, docs):
    rows = queries.op6_toxicity(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_op7_recall_order_and_scores(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), np.float64)
    place = {v: i for i, v in enumerate(ids.tolist())}
    got = {}
    for r in queries.op7_multi_index_search(spark, SMALL).collect():
        got.setdefault(r["query_id"], []).append(r)
        assert abs(r["score"] - x[place[r["query_id"]]] @ x[place[r["vec_id"]]]) < 1e-9
    hits = 0
    for v in ids[ids % 20 == 0].tolist():
        mine = sorted(got[v], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and v not in {r["vec_id"] for r in mine}
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        score = x @ x[place[v]]
        want = sorted((i for i in ids.tolist() if i != v), key=lambda i: (-score[place[i]], i))[:20]
        hits += len(set(want) & {r["vec_id"] for r in mine})
    assert hits >= 0.9 * 20 * len(got)


def test_op8_pieces_of_all_documents(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = {}, {}
    for r in queries.op8_packing(spark, SMALL).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(docs)
    for i, text in docs.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    for of in sequences.values():
        at = 0
        for r in sorted(of, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096


def test_op9_base_rules(spark, docs):
    import re

    rows = {r["doc_id"]: r for r in queries.op9_robust_outliers(spark, SMALL).collect()}
    assert set(rows) == set(docs)
    for i, text in docs.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines, seen, again = text.split("\n"), set(), 0
        for line in lines:
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        grams = [tuple(found[j : j + 3]) for j in range(len(found) - 2)]
        counts = {}
        for g in grams:
            counts[g] = counts.get(g, 0) + 1
        repeated = {k for j, g in enumerate(grams) if counts[g] > 1 for k in range(j, j + 3)}
        failed = len(found) < 50 or 100 * len(repeated) > 50 * len(found)
        want = (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated), failed)
        r = rows[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
        assert not (r["base_failed"] and r["kept"])


def test_op1_and_op3_on_documents(spark, docs):
    rows = queries.op1_minhash_near_dedup(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    for r in queries.op3_substring_chains(spark, SMALL).collect():
        ours = docs[r["doc_id"]][r["start_char"] : r["end_char"]].lower().split()
        theirs = docs[r["source_doc_id"]].lower().split()[r["source_start_word"] : r["source_end_word"]]
        assert len(ours) == r["end_word"] - r["start_word"] >= 50 and r["source_doc_id"] < r["doc_id"]
        assert len(set(ours) & set(theirs)) >= 0.5 * len(set(ours))
