"""SentencePiece encoding against a plain Viterbi search, and exact round trips."""

import struct

import pytest

from plantflow.llm import pieces


def field(number, wire, value):
    head = bytes([number << 3 | wire])
    return head + (bytes([len(value)]) + value if wire == 2 else value)


def model_file(words, prefix=True, fallback=True):
    own = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL)]
    own += [(f"<0x{i:02X}>", 0.0, pieces.BYTE) for i in range(256)] if fallback else []
    own += [(w, s, pieces.NORMAL) for w, s in words.items()]
    data = b"".join(
        field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in own
    )
    return data + field(3, 2, field(3, 0, bytes([prefix])) + field(4, 0, b"\0"))


@pytest.fixture(scope="module")
def real(spark):
    return pieces.load(spark)


def slow(model, text):
    """Viterbi over one text, place by place."""
    whole = model.normal(text)
    known = {p: i for i, p in enumerate(model.texts) if model.kinds[i] in (pieces.NORMAL, pieces.USER)}
    longest = max(map(len, known), default=0)
    best = [None] * (len(whole) + 1)
    best[0] = (0.0, 0, -1)
    for i, byte in enumerate(whole):
        if best[i] is None:
            continue
        width = 1 + (byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0)
        steps = [(i + n, model.scores[known[whole[i : i + n]]], known[whole[i : i + n]]) for n in range(1, longest + 1) if i + n <= len(whole) and whole[i : i + n] in known]
        if not any(j == i + width for j, _, _ in steps):
            steps.append((i + width, model.unknown_score, -1))
        for j, score, piece in steps:
            if best[j] is None or best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, i, piece)
    out, at = [], len(whole)
    while at:
        _, low, piece = best[at]
        own = [piece] if piece >= 0 else [int(model.byte_ids[x]) for x in whole[low:at]] if model.fallback else [model.unknown]
        out, at = own + out, low
    return out


def cut(model, texts):
    ids, counts = model.encode(texts)
    ends = counts.cumsum()
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts)]


ODD = ["", " ", "  a  b ", "\n", "é日本語 \U0001f600 x", "\x00\x01", "a" * 3000, "tab\tand  blanks   ", "ﬀ㍍ " * 30]


def test_real_model(real, texts):
    short = [t for _, t in texts if t and len(t) < 2500][:40] + ODD
    assert cut(real, short) == [slow(real, t) for t in short]
    ids, counts = real.encode(short)
    assert real.decode(ids, counts) == short


@pytest.mark.parametrize("fallback", [True, False])
def test_pieces_behind_blanks_and_ties(fallback):
    words = {"▁": -2.0, "a": -3.0, "b": -3.0, "ab": -6.0, "b▁a": -1.5, "▁ab": -8.0, "é": -1.0, "aa": -6.0, "▁a": -5.0}
    model = pieces.Model(model_file(words, fallback=fallback))
    assert not model.by_words
    texts = ["ab ab aab", "aaaa", "é è", "b a b a b", "", "zz ab"]
    assert cut(model, texts) == [slow(model, t) for t in texts]


def test_models_that_rewrite_are_refused():
    with pytest.raises(ValueError):
        pieces.Model(model_file({"a": -1.0}) + field(3, 2, field(2, 2, b"x")))


def test_double_array_finds_every_key_and_nothing_else():
    keys = {f"k{i * 7919 % 1000}".encode(): i for i in range(1000)} | {b"\xff": 5000, b"": 1}
    trie = pieces.double_array({k: v for k, v in keys.items() if k})

    def find(key):
        state = 0
        for c in key:
            to = trie.base[state] + c
            if to >= len(trie.check) or trie.check[to] != state:
                return -1
            state = to
        return trie.value[state]

    assert all(find(k) == v for k, v in keys.items() if k)
    assert find(b"k1000") == find(b"q") == find(b"k") == -1


def test_operators(docs, texts, real, nothing):
    encoded = pieces.encode(docs, real, carried=("ids",))
    found = pieces.decode(encoded, real).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row.decoded == row.text and row.row.ids == 7
        assert (row.ids is None) == (row.text is None)
    checked = pieces.encode(docs, real, carried=("bucket",), check=True).collect()
    assert all(r.round_trip and r.row.bucket == 7 for r in checked)
    assert sorted(((r.doc_id, r.ids) for r in checked), key=repr) == sorted(((r.doc_id, r.ids) for r in found), key=repr)
    digests = pieces.digests(docs, real).collect()
    assert all(r.round_trip for r in digests)
    assert sorted((str(r.doc_id), r.n_tokens) for r in digests) == sorted((str(r.doc_id), len(r.ids or [])) for r in checked)
    assert pieces.digests(nothing, real).collect() == []
