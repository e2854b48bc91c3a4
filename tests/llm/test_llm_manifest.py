"""Merkle manifest, token alignment and quality rules against plain versions of them."""

import hashlib
import json
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import Row, functions as F
from tokenizers import Tokenizer

from compare import connect, differences
from deliverylens.llm import alignment, merkle, queries, rules
from deliverylens.llm.bpe import byte_letters

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
sampled = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


def sample(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def as_set(df):
    return Counter(tuple(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in df.collect())


# --- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_tree(leaves):
    """All levels of a tree, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[k : k + 3])) for k in range(0, len(row), 3)])
    return levels


def plain_manifest(rows):
    """Rows of the manifest query, by lists."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    top = plain_tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for k, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            cur, proof = plain_leaf(r, text), ""
            for levels, i in ((trees[s], k), (top, at)):
                for row in levels[:-1]:
                    run = row[i // 3 * 3 : i // 3 * 3 + 3]
                    others = [h for j, h in enumerate(run) if j != i % 3]
                    proof += "".join(others)
                    cur = sha("".join([*run[: i % 3], cur, *run[i % 3 + 1 :]]))
                    i //= 3
            root = top[-1][0]
            out.append(
                Row(doc_id=r["doc_id"], leaf=leaf, subroot=trees[s][-1][0], root=root, proof_sha256=sha(proof), folded_root=cur, verified=cur == root)
            )
    return Counter(tuple(sorted(r.asDict().items())) for r in out)


@pytest.mark.parametrize("levels", range(1, 9))
def test_layout_addresses_are_a_permutation_of_halves(levels):
    where = merkle.addresses(levels)
    assert sorted(np.concatenate(where)) == list(range(merkle.subtree_nodes(levels)))
    assert where[0][0] == 0
    if levels > 1:
        top = levels // 2
        # the top half comes first, then each bottom half in one run
        assert max(where[top - 1]) < merkle.subtree_nodes(top)
        size = merkle.subtree_nodes(levels - top)
        for k in range(3**top):
            below = np.concatenate([where[d][k * 3 ** (d - top) : (k + 1) * 3 ** (d - top)] for d in range(top, levels)])
            assert sorted(below) == list(range(merkle.subtree_nodes(top) + k * size, merkle.subtree_nodes(top) + (k + 1) * size))


@sampled
def test_manifest_query_matches_lists(spark):
    assert as_set(queries.op11_merkle_manifest(spark, SF_DIR)) == plain_manifest(sample(spark))


@sampled
@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_quality_rules"])
def test_matches_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF_DIR), connect(SF_DIR), queries.oracle_sql()[name]) == []


@pytest.mark.parametrize("n", [0, 1, 2, 10, 100])
def test_manifest_over_several_tiers(spark, n):
    """Blocks of nine leaves, so that the tree needs tiers; sources of all sizes, one null."""
    rng = random.Random(n)
    # most rows in one source, some sources of a single row
    sources = [None, "", "hot", "é", "~", *[f"s{k:02}" for k in range(12)]]
    rows = [
        {
            "doc_id": k * 7 - 3,
            "text": rng.choice([None, "", "a\nb", "ü\n\n", "x"]),
            "lang": rng.choice([None, "en"]),
            "source": "hot" if k % 3 else sources[k % len(sources)],
            "n_chars": rng.choice([None, 4]),
        }
        for k in range(n)
    ]
    names = ("doc_id", "text", "lang", "source", "n_chars")
    docs = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], DOC)
    docs = docs.withColumn("key", F.lit(1)).withColumn("leaf", F.lit("x")).withColumn("claimed", F.lit(None))
    assert as_set(merkle.audit_manifest(docs, merkle.without_breaks(docs), block_levels=3)) == plain_manifest(rows)


def test_manifest_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a\n", "en", "s", 2), (1, "a\n", "en", "s", 2), (1, None, None, "s", None), (None, "b\n", "en", "s", 2), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOC)
    names = ("doc_id", "text", "lang", "source", "n_chars")
    assert as_set(merkle.audit_manifest(docs, merkle.without_breaks(docs))) == plain_manifest([dict(zip(names, r)) for r in rows])


def test_manifest_catches_any_change(spark):
    docs = spark.createDataFrame([(k, f"text {k}", "en", f"s{k % 2}", 5) for k in range(20)], DOC)
    changed = F.when(F.col("doc_id") == 7, "other").otherwise(F.col("text"))
    found = merkle.audit_manifest(docs, changed).collect()
    assert [r.doc_id for r in found if not r.verified] == [7]
    assert len({r.root for r in found}) == 1


# --- alignment of two tokenizers


def plain_alignment(texts):
    """(n_a, n_b, n_groups, n_links, groups_sha256, linked pairs) of each text, with plain encoders and all pairs of tokens compared."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    spec = json.load(open(A))
    letters = {c: b for b, c in enumerate(byte_letters())}
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        ids_a = tok.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = sp.encode(text or "")
        name = {v: k for k, v in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        bytes_a = [bytes(letters[c] for c in name[i]) for i in ids_a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            out.append((0, 0, 0, 0, "", []))
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            ends = np.cumsum([len(t) for t in tokens]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links = []
        first = 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for end in both:
            part = [[i for i, (s, e) in zip(ids, sp_) if start <= s and e <= end] for ids, sp_ in zip((ids_a, ids_b), spans)]
            groups.append("|".join(",".join(map(str, p)) for p in part))
            start = end
        out.append((len(ids_a), len(ids_b), len(groups), len(links), sha(";".join(groups)), links))
    return out


def plain_alignment_rows(ids, texts):
    found = plain_alignment(texts)
    count = Counter(p for *_, links in found for p in set(links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return Counter(
        tuple(sorted(dict(doc_id=k, n_a=f[0], n_b=f[1], n_groups=f[2], n_links=f[3], groups_sha256=f[4], n_best=sum(count[p] == best[p[0]] for p in f[5]), count_sum=sum(count[p] for p in f[5])).items()))
        for k, f in zip(ids, found)
    )


ODD = [None, "", " ", "a", "  two  spaces ", "tab\tand\nbreaks\r\n\n", "<|endoftext|> <s> </s> <unk>", "über naïve café", "日本語 テスト", "▁ lower one eighth", "é and ﬁ", "🙂🙂 emoji", "x" * 500, "the the the the", "\x00\x1c\x85\xa0　", "ab " * 300]


def test_alignment_matches_all_pairs(spark):
    texts = ODD + ["the the the the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pair", F.lit(1)).withColumn("n", F.lit("x"))
    assert as_set(alignment.align_tokens(docs, A, B)) == plain_alignment_rows(range(len(texts)), texts)


@sampled
def test_alignment_query_matches_all_pairs(spark):
    rows = sample(spark)
    # the plain version looks through all tokens for each group, so the longest texts take it too long
    short = [r for r in rows if r["text"] is None or len(r["text"]) < 6000]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in short], "doc_id long, text string")
    expected = plain_alignment_rows([r["doc_id"] for r in short], [r["text"] for r in short])
    assert as_set(alignment.align_tokens(docs, A, B)) == expected
    assert queries.op12_token_alignment(spark, SF_DIR).count() == len(rows)


def test_alignment_of_nothing_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokens(empty, A, B).count() == 0
    twice = spark.createDataFrame([(1, "one text"), (1, "one text"), (None, None)], "doc_id long, text string")
    assert as_set(alignment.align_tokens(twice, A, B)) == plain_alignment_rows([1, 1, None], ["one text", "one text", None])


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_give_the_same_overlaps(step):
    rng = np.random.default_rng(step)
    for size in (0, 1, 5, 200):
        a, b = (np.unique(rng.integers(1, 4 * size + 2, size)) for _ in range(2))
        end = max([0, *a, *b]) + 1
        a, b = np.append(a, end), np.append(b, end)
        link_a, link_b, end_a, end_b = alignment.overlaps(a, b, step)
        spans = [list(zip([0, *x[:-1]], x)) for x in (a, b)]
        links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if max(s, t) < min(e, f)]
        assert list(zip(link_a.tolist(), link_b.tolist())) == links
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[end_a].tolist() == shared == b[end_b].tolist()
        i, j = alignment.diagonals(a, b, step)
        assert all(x + y == min(k * step, len(a) + len(b)) for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())))


# --- quality rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_rules(rows, trusted):
    """Rows of the quality rules, by counting."""
    grams = {}
    raw, target = Counter(), Counter()
    for at, r in enumerate(rows):
        words = WORD.findall((r["text"] or "").lower())
        own = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        grams[at] = [zlib.crc32(g.encode()) % rules.BUCKETS for g in own]
        raw.update(grams[at])
        if r["doc_id"] in trusted:
            target.update(grams[at])
    share = target.total() / raw.total() if raw else 0
    weight = {b: math.floor(math.log((target[b] + rules.SMOOTHING) / (n * share + rules.SMOOTHING)) * 1e6 + 0.5) for b, n in raw.items()}
    out = []
    for at, r in enumerate(rows):
        text = r["text"] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        count = Counter(windows)
        repeated = {k + d for k, w in enumerate(windows) if count[w] > 1 for d in range(3)}
        total = sum(weight[b] for b in grams[at])
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        out.append(dict(doc_id=r["doc_id"], n_words=len(words), word_chars=sum(map(len, words)), n_symbols=sum(c in "#*$%&|<>" for c in text), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(repeated), base_failed=failed, kept=not failed and total >= rules.LEAST_SCORE * len(grams[at]), n_grams=len(grams[at]), ratio_sum=total))
    return Counter(tuple(sorted(r.items())) for r in out)


@sampled
def test_rules_query_matches_counting(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    good = {r.doc_id for r in labels if r.quality == 1}
    assert as_set(queries.op13_quality_rules(spark, SF_DIR)) == plain_rules(sample(spark), good)


def test_rules_of_odd_texts(spark):
    texts = [*ODD, "a a a a", "one two three one two three", " \t\n\x0b\x0c\r", "x\n\nx\n x\nx", "#*$%&|<> ###", "🙂 é\nÉ 🙂", "w " * 60, " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k % 40}" for k in range(20_000))]
    rows = [{"doc_id": k if k % 5 else None, "text": t} for k, t in enumerate(texts)] + [{"doc_id": 1, "text": "again"}]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string").withColumn("bucket", F.lit(0)).withColumn("_id", F.lit(0))
    trusted = spark.createDataFrame([(len(texts) - 2,), (1,), (1,), (999,), (None,)], "doc_id long")
    assert as_set(rules.apply_rules(docs, trusted)) == plain_rules(rows, {len(texts) - 2, 1})


def test_rules_without_documents_or_trusted_ones(spark):
    nobody = spark.createDataFrame([], "doc_id long")
    assert rules.apply_rules(spark.createDataFrame([], "doc_id long, text string"), nobody).count() == 0
    docs = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(80)))], "doc_id long, text string")
    found = rules.apply_rules(docs, nobody).first()
    assert found.kept and found.ratio_sum == 0


@sampled
def test_rules_tell_good_from_bad(spark):
    """Labelled rows that pass the base rules: good ones stay, bad ones go."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = queries.op13_quality_rules(spark, SF_DIR).where("not base_failed").join(labels, "doc_id")
    good, bad = (judged.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("double"))).first()[0] for q in (1, 0))
    assert good == 1.0 and (bad is None or bad < 0.5)


def test_trusted_ids_need_every_row_to_agree(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    assert [r.doc_id for r in rules.trusted_ids(labels).collect()] == [1]
