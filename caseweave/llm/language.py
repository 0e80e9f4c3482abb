"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text is built.  A text is parsed
against it from left to right: the longest match becomes a phrase, then the next
one starts.  The language whose automaton needs the fewest phrases per character
wins.  The automata are complete transition tables, so that one step of many
texts and all languages is one array lookup.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from caseweave.llm.workers import kept, prepare, tidy


#: Bounds of the labelled sample: at most about this many characters per language and in all
#: (languages share them equally), in pieces of PIECE_CHARS or more, of so many languages.
CHARS_PER_LANGUAGE, CHARS_IN_ALL = 60_000, 240_000
PIECE_CHARS = 300
MAX_LANGUAGES = 400
#: The most frequent letters have codes of their own; the others share one.
ALPHABET = 120
SEGMENT = 1024
BATCH_CHARS = 1 << 19
UNDETERMINED = "und"
RESULT = "lang string, score double, phrases_per_char double"


@dataclass(frozen=True)
class Profile:
    """The labelled sample; small enough to travel with the tasks, which build the tables."""

    samples: tuple[tuple[str, str], ...]

    @property
    def key(self) -> str:
        return hashlib.sha256(repr(self.samples).encode()).hexdigest()


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    chars: int = CHARS_PER_LANGUAGE,
    doubt_labels: bool = False,
) -> Profile:
    """A profile from a bounded sample of the rows with a text and a label.

    Texts are picked by a hash of their id, about ``chars / PIECE_CHARS`` of each language
    and an equal piece of each, so that a language contributes about ``chars``
    characters however many rows it has.  Fewer texts give longer pieces.  More
    languages get fewer characters each, so that the tables have a bounded size
    whatever the labels are; more than MAX_LANGUAGES labels are an error.  With
    ``doubt_labels``, pieces that the other half of the sample finds to be in
    another language are left out, so that wrong labels do not teach themselves.
    """
    usable = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("body"), F.xxhash64(id_col).alias("turn")
    ).where(F.col("lang").isNotNull() & F.col("body").isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if not counts:
        return Profile(())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values; merge or drop the rare ones")
    chars = min(chars, CHARS_IN_ALL // len(counts))
    texts = max(1, chars // PIECE_CHARS)
    scale = 1 << 30
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(scale, scale * texts // n)))])
    piece = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(-(-chars // min(n, texts))))])
    picked = (
        usable.where(F.pmod("turn", F.lit(scale)) < F.try_element_at(share, F.col("lang")))
        .select("lang", "turn", F.substring("body", F.lit(1), F.try_element_at(piece, F.col("lang"))).alias("body"))
        .collect()
    )
    gathered: dict[str, list[str]] = {k: [] for k in counts}
    for row in sorted(picked, key=lambda r: (r["lang"], r["turn"])):
        gathered[row["lang"]].append(row["body"])
    if doubt_labels:
        gathered = _undisputed(gathered)
    return Profile(tuple((k, "\n".join(v)[:chars]) for k, v in sorted(gathered.items())))


def _undisputed(gathered: dict[str, list[str]]) -> dict[str, list[str]]:
    """The pieces whose label the other half agrees with; all of them if it knows no better."""
    halves = [{k: v[h::2] for k, v in gathered.items()} for h in (0, 1)]
    kept_: dict[str, list[str]] = {k: [] for k in gathered}
    for own, other in (halves, halves[::-1]):
        judges = build(Profile(tuple((k, "\n".join(v)) for k, v in sorted(other.items()) if v)))
        for k, pieces in own.items():
            found = identify(judges, pieces)["lang"] if pieces else []
            kept_[k] += [p for p, lang in zip(pieces, found, strict=True) if lang in (k, UNDETERMINED) or k not in judges.languages]
    return {k: kept_[k] or v for k, v in gathered.items()}


@dataclass
class Automata:
    """All languages in one table: ``table[state + code]`` is the next state, or its
    complement if a phrase ended before this character."""

    languages: list[str]
    codes: np.ndarray
    table: np.ndarray
    roots: np.ndarray
    size: int = field(default=0)


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case form and whether it is a letter."""
    lower = np.fromiter((ord(chr(i).lower()[0]) for i in range(0x110000)), np.uint32, 0x110000)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return lower, letter


def build(profile: Profile, alphabet: int = ALPHABET) -> Automata:
    lower, letter = _letters()
    seen = Counter()
    for _, text in profile.samples:
        seen.update(c for c in text.lower() if c.isalpha())
    codes = np.zeros(0x110000, np.uint8)
    codes[letter] = 1  # letters without a code of their own
    for number, (c, _) in enumerate(sorted(seen.items(), key=lambda kv: (-kv[1], kv[0]))[:alphabet], 2):
        codes[ord(c)] = number
    codes = codes[lower]
    size = int(codes.max()) + 1
    texts = [_coded([text], codes)[0] for _, text in profile.samples]
    # Room for the largest automata there can be; what is not touched takes no memory.
    table = np.empty(sum(2 * len(t) + 2 for t in texts) * size, np.int32)
    roots, used = [], 0
    for text in texts:
        roots.append(used)
        used = _add_automaton(table, used, text, size)
    return Automata([k for k, _ in profile.samples], codes, table[:used], np.array(roots, np.int32), size)


def _add_automaton(table: np.ndarray, base: int, codes: np.ndarray, size: int) -> int:
    """Writes the smallest automaton that reads every substring from ``base`` on; returns its end.

    ``table[state + code]`` is the next state.  States are counted in steps of
    ``size``.  What has no transition ends the phrase and starts anew, which is the
    complement of the state after it, also for a character that the text never has.
    """
    moves, none = memoryview(table), memoryview(np.full(size, -1, np.int32))
    moves[base : base + size] = none
    link, length, last, end = {base: -1}, {base: 0}, base, base + size
    for c in codes.tolist():
        new, end = end, end + size
        moves[new:end] = none
        length[new], link[new] = length[last] + 1, base
        at = last
        while at >= 0 and moves[at + c] < 0:
            moves[at + c] = new
            at = link[at]
        if at >= 0:
            old = moves[at + c]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                copy, end = end, end + size
                moves[copy:end] = moves[old : old + size]
                length[copy], link[copy] = length[at] + 1, link[old]
                link[old] = link[new] = copy
                while at >= 0 and moves[at + c] == old:
                    moves[at + c] = copy
                    at = link[at]
        last = new
    own = table[base:end].reshape(-1, size)
    start = np.where(own[0] < 0, base, own[0])
    for low in range(0, len(own), 4096):  # a piece at a time, as a mask of all would be half as large as the table
        part = own[low : low + 4096]
        np.copyto(part, ~start, where=part < 0)
    return end


def _coded(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts in one array, and where each text begins in it (and the end).

    What is no letter is code 0, and a run of it is one.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([0, *map(len, texts)])
    coded = codes[points]
    keep = np.ones(len(coded), bool)
    keep[1:] = (coded[1:] != 0) | (coded[:-1] != 0)
    inner = ends[:-1][ends[:-1] < len(coded)]
    keep[inner] = True
    bounds = np.concatenate([[0], np.cumsum(keep)])[ends]
    return coded[keep], bounds


def count_phrases(automata: Automata, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases per text and language, and each text's characters and letters.

    A text is parsed in segments of SEGMENT characters, each from the start of
    the automata, so that a very long text takes no more steps than others.
    """
    coded, bounds = _coded(texts, automata.codes)
    sizes = np.diff(bounds)
    letters = np.diff(np.concatenate([[0], np.cumsum(coded != 0)])[bounds])
    parts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), parts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = bounds[owner] + within * SEGMENT
    lengths = np.minimum(SEGMENT, sizes[owner] - within * SEGMENT)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths, owner = starts[by_length], lengths[by_length], owner[by_length]
    many = len(automata.languages)
    phrases = np.ones((many, len(starts)), np.int32)  # the one that is open at the end
    if len(starts):
        padded = np.concatenate([coded, np.zeros(SEGMENT, np.uint8)])
        steps = np.lib.stride_tricks.sliding_window_view(padded, SEGMENT)[starts].T.astype(np.int32)
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        state = np.repeat(automata.roots[:, None], len(starts), axis=1)
        for step, n in enumerate(active):
            moved = automata.table[state[:, :n] + steps[step, :n]]
            ended = moved >> 31
            phrases[:, :n] -= ended
            state[:, :n] = moved ^ ended
    total = np.zeros((many, len(texts)), np.int64)
    for k in range(many):
        total[k] = np.bincount(owner, phrases[k], len(texts)).astype(np.int64)
    return total.T, sizes, letters


def automata_of(profile: Profile) -> Automata:
    """Built once per worker process."""
    return kept(profile.key, lambda: build(profile))


def identify(automata: Automata, texts: list[str | None]) -> pd.DataFrame:
    """Language, score and phrases per character of each text (see ``RESULT``)."""
    langs, scores, rates = [], [], []
    start = 0
    while start < len(texts):
        end, chars = start, 0
        while end < len(texts) and (end == start or chars + len(texts[end] or "") <= BATCH_CHARS):
            chars += len(texts[end] or "")
            end += 1
        phrases, sizes, letters = count_phrases(automata, [t or "" for t in texts[start:end]])
        start = end
        if not automata.languages:
            langs += [UNDETERMINED] * len(sizes)
            scores += [0.0] * len(sizes)
            rates += [1.0] * len(sizes)
            continue
        best = phrases.argmin(axis=1)
        least = phrases.min(axis=1)
        second = np.partition(phrases, 1, axis=1)[:, 1] if phrases.shape[1] > 1 else np.full(len(best), np.inf)
        known = letters > 0
        langs += [automata.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        scores += np.where(known, 1 - least / np.maximum(second, 1), 0.0).tolist()
        rates += np.where(known, least / np.maximum(sizes, 1), 1.0).tolist()
    return pd.DataFrame({"lang": langs, "score": scores, "phrases_per_char": rates})


def language_of(text: Column, profile: Profile) -> Column:
    """A struct (lang, score, phrases_per_char) for each text.

    ``und`` with score 0 for a null, an empty text and one without any letter, or
    if nothing was learned.  The score is 1 - fewest / second fewest phrases; on
    a tie (score 0) the first language by name is given.  With one learned
    language the score is 1.  Whole texts are parsed.
    """
    prepare()

    @pandas_udf(RESULT)
    @tidy
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automata = automata_of(profile)
        for batch in batches:
            yield identify(automata, batch.tolist())

    # Declared non-deterministic only so that filters above do not copy the call.
    return predict.asNondeterministic()(text)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def predict_languages(
    docs: DataFrame, profile: Profile, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, phrases_per_char.

    Repeated rows and null ids are rows like others, an empty table gives an
    empty result, and no column but the text has a part in the prediction.
    """
    found = docs.select(
        F.col(id_col).alias(id_col),
        held_out(F.col(id_col)).alias("held_out"),
        language_of(F.col(text_col).cast("string"), profile).alias("found"),
    )
    return found.select(
        id_col, "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.phrases_per_char"
    )
