"""Cross-tokenizer alignment against loops over all pairs of tokens."""

import hashlib
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from quern.llm.cross_tokens import AlignSetup, align_tokens  # noqa: E402

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def token_bytes():
    """Bytes of A by its decoder's alphabet, of B by its pieces."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    keep = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    letters, extra = {}, 0
    for byte in range(256):
        letters[chr(byte) if byte in keep else chr(256 + extra)] = byte
        extra += byte not in keep
    of_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))

    def of_b(i):
        return bytes.fromhex(b.id_to_piece(i)[3:5]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    return a, b, of_a, of_b


def spans(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(size(i))))
        at += len(size(i))
    return out


def by_loops(texts):
    a, b, of_a, of_b = token_bytes()
    coded = []
    for t in texts:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if not (b"".join(map(of_a, x)) == raw == b"".join(map(of_b, y))):
            x, y = [], []
        coded.append((spans(x, of_a), spans(y, of_b)))
    links = [[(i, j) for i, s, e in x for j, u, v in y if s < v and u < e] for x, y in coded]
    counts = Counter(p for own in links for p in own)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for (x, y), own in zip(coded, links, strict=True):
        ends = sorted({e for *_, e in x} & {e for *_, e in y})
        groups = []
        for begin, end in zip([0, *ends], ends, strict=False):
            inside = lambda z: ",".join(str(i) for i, s, _ in z if begin <= s < end)  # noqa: B023, E731
            groups.append(f"{inside(x)}|{inside(y)}")
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""
        out.append((len(x), len(y), len(ends), len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), digest))
    return out


@pytest.mark.parametrize("frequent", [1 << 18, 40, 1])
def test_against_loops(spark, hard, frequent):
    """With few or no frequent pairs the others go through the join."""
    more = ["<|endoftext|> <s></s><unk> <0x41>", "▁a", "漢字かな　混じり", "x = {'k': [1, 2]}\n\tdef f(): pass\n", "naïve café ﬁn é"]
    docs = hard.unionByName(spark.createDataFrame([(60 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.withColumnRenamed("score", "n_a").withColumnRenamed("host", "row")
    found = align_tokens(docs, ["doc_id", "text"], A, B, setup=AlignSetup(batch_chars=3000, frequent=frequent)).collect()
    expected = by_loops([r.text for r in found])
    assert len(found) == docs.count()
    for r, e in zip(found, expected, strict=True):
        assert tuple(r)[2:] == e
        assert r.n_links == max(r.n_a + r.n_b - r.n_groups, 0)


def test_groups_themselves(spark):
    docs = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in align_tokens(docs, ["doc_id"], A, B, groups=True).collect()}
    assert found[1].groups.count(";") == found[1].n_groups - 1 and found[2].groups == "" and found[2].n_a == 0


def test_empty_table(nothing):
    assert align_tokens(nothing, ["doc_id"], A, B).collect() == []


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "lorem ipsum, dolor " * 60_000), (2, "q" * 200_000)], "doc_id long, text string")
    found = {r.doc_id: r for r in align_tokens(docs, ["doc_id"], A, B).collect()}
    assert found[1].n_groups > 100_000 and found[2].n_links > 1000
