"""Token ids, packing and record files against the tokenizer itself."""

import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caseweave.llm import packing, records, tokens
from caseweave.llm.packing import Slots, cut_documents, pack_documents, plan
from caseweave.sinks.staging import shared_folder

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TRICKY = [
    "  a  b", "a\n\nb", " \n x", "x \n", "\t\tq", "don't DON'T it's we'll", "<|endoftext|> a  <|endoftext|>", "\x1c a",
    "ΑΣ ΣΑΣ", "e\u0301 \u0301x", "a\u00a0b\u2003c", "Été, ÑÀÇ!? ß. ÿ 3×4÷2 ×", "word." * 40, "\r\n\r\nx", " " * 30 + "z", "a_b, c-d; (e)", "İstanbul", "\n\n ", "a \n\nb", "a\n\nb\n", "a\n b \n", " \nx", "\n\n x",
]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_tokenizers_ids(path, prose, oddities):
    encoder, tokenizer = tokens.Encoder(path), Tokenizer.from_file(path)
    for text in TRICKY + prose(30) + [t or "" for t in oddities]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        for _ in range(2):  # fresh and remembered
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Zé\n\t .,'1-×<|>\u0301\u00a0ßΣ"), max_size=30))
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_any_text(path, text):
    want = Tokenizer.from_file(path) if path not in _loaded else _loaded[path]
    _loaded[path] = want
    assert np.frombuffer(tokens.encoder(path).encode(text), "<u4").tolist() == want.encode(text, add_special_tokens=False).ids


_loaded = {}


def test_forgetting_changes_nothing(prose, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    encoder, tokenizer = tokens.Encoder(BYTE), Tokenizer.from_file(BYTE)
    for text in prose(10):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def sequences_of(rows):
    """Checks that sequences are gapless; returns how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def test_packing_documents(table, prose, oddities):
    given = list(enumerate(prose(150, words=400) + oddities + ["long words here " * 3000]))
    got = pack_documents(table(given), WORD).collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = {}
    for i, t in given:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            want[i, k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert len(got) == len(want)
    total = sum(n for _, n, _ in want.values())
    assert sequences_of(got) <= -(-total // 2048) + 1


def best_fit(lengths, capacity):
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(capacity - length)
    return len(room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_is_best_fit(lengths):
    counts = Counter(lengths)
    slots = plan(counts, 50)
    taken, ranks = {}, {}
    for s in slots:
        for rank in range(s.low, s.high):
            k = rank - s.low
            place = (s.sequence + k // s.each, s.offset + k % s.each * s.length)
            taken.setdefault(place[0], []).append((place[1], s.length))
            ranks.setdefault(s.length, []).append(rank)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in taken.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 50
    assert len(taken) == best_fit(lengths, 50)


def test_plan_is_short_for_any_number_of_documents():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    assert len(plan(counts)) < 20_000
    assert plan({2048: 7}) == [Slots(2048, 0, 7, 0, 1, 0)]


def test_packing_odd_rows(table, clashing, rows, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 2)
    assert rows(pack_documents(table([]), WORD)) == []
    given = [(None, "a b"), (1, "a b"), (1, "a b"), (1, None), (2, "")] * 3
    got = pack_documents(clashing(given), WORD).collect()
    assert len(got) == len(given) and sequences_of(got) == 1
    assert rows(cut_documents(table([(1, None)]), WORD, end_id=None)) == []


def test_records_round_trip(table, rows, prose, oddities):
    given = [(i - 9, t) for i, t in enumerate(prose(60) + oddities)]
    df = table(given)
    folder = f"{shared_folder(df.sparkSession)}/round-{os.getpid()}"
    manifest = records.write_records(df, folder, BYTE, shard_bytes=400)
    got = rows(records.read_records(df.sparkSession, folder, manifest))
    tokenizer, start, want = Tokenizer.from_file(BYTE), 0, []
    for i, t in given:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want, key=str)
    files = sorted(manifest.collect())
    assert len(files) > 1
    assert records.read_one(folder, files[1]["file"], 0)[0] == given[files[0]["records"]][0]
    last = files[0]["records"] - 1
    assert records.read_one(folder, files[0]["file"], last)[0] == given[last][0]


def test_damage_is_noticed(table):
    df = table([(1, "some text"), (2, "more text")])
    folder = f"{shared_folder(df.sparkSession)}/damaged-{os.getpid()}"
    manifest = records.write_records(df, folder, BYTE)
    path = f"{folder.removeprefix('file://')}/{manifest.first()['file']}.rec"
    data = bytearray(open(path, "rb").read())
    data[20] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(df.sparkSession, folder, manifest).collect()


def test_records_odd_rows(clashing, table, rows):
    assert rows(records.round_trip(table([]), BYTE)) == []
    given = [(None, "a"), (5, None), (5, "b"), (5, "b"), (4, "")]
    got = rows(records.round_trip(clashing(given), BYTE), "doc_id", "n_tokens")
    assert got == sorted([(None, 2), (5, 1), (5, 2), (5, 2), (4, 1)], key=str)


def test_wide_ids():
    ids = np.array([70_000, 1], "<u4").tobytes()
    assert records.unpack_payload(records.pack_payload(None, ids, 4), 4) == (None, ids)
