import numpy as np
import pyarrow as pa

from caseweave.llm.spans import CHUNK, LONG, WordList, buffers, in_pieces, inner, runs_within, span_numbers

WORDS = inner((9, 13), (32, 32))


def bytes_of(text):
    return np.frombuffer(text.encode(), np.uint8)


def thue_morse(order):
    word = "a"
    for _ in range(order):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_equal_words_have_equal_numbers_wherever_they_lie():
    words = ["x", "naïve", "🙂", "a" * LONG, "a" * (LONG + 1), "b" * (3 * CHUNK), "end"]
    text = " ".join(words) + "  " + "pad " * CHUNK + " ".join(words)
    data = bytes_of(text)
    starts, ends = runs_within(data, WORDS)
    numbers = span_numbers(data, starts, ends)
    many = len(words)
    assert (numbers[:many] == numbers[-many:]).all()
    assert len(set(numbers.tolist())) == many + 1


def test_thue_morse_words_differ():
    for order in range(1, 12):
        word = thue_morse(order)
        pair = word + " " + word.translate(str.maketrans("ab", "ba"))
        starts, ends = runs_within(bytes_of(pair), WORDS)
        assert len(set(span_numbers(bytes_of(pair), starts, ends).tolist())) == 2


def test_word_list_compares_bytes():
    data = bytes_of("one two three two")
    words, place = WordList.of(data, *runs_within(data, WORDS))
    assert place[1] == place[3] and len(words.numbers) == 3
    other = bytes_of("two four thre threee one")
    starts, ends = runs_within(other, WORDS)
    assert words.find(other, starts, ends).tolist() == [place[1], -1, -1, -1, place[0]]
    wrong = np.full(5, words.numbers[place[1]])  # every word claims to be "two"
    assert words.find(other, starts, ends, wrong).tolist() == [place[1], -1, -1, -1, -1]


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([b"", b"abc", b"d" * 50, b"", b"ef"])], names=["body"])
    for size in (1, 4, 100):
        pieces = list(in_pieces(iter([batch, batch]), "body", size))
        assert [x for p in pieces for x in p["body"].to_pylist()] == batch["body"].to_pylist() * 2
        assert [buffers(p["body"])[0].tobytes() for p in pieces] == [b"".join(p["body"].to_pylist()) for p in pieces]
