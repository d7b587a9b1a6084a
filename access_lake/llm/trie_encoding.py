"""Operator 11: byte-level BPE encoding and decoding over a trie of words.

A BPE encoding has two properties that make prefixes shareable. Cut an
encoding after any token, and the left part is the encoding of its own text.
And a sequence of tokens is an encoding exactly if each two neighbours are:
merging the text of the pair gives the pair again. So the encoding of a
prefix ends in one certain *last token*, the only token that is a suffix of
the prefix, and is compatible with the last token of the prefix before it.

Texts are taken in blocks of some megabytes. The distinct words that a block
brings are a trie; it is walked depth first (the sorted words, each joining
its predecessor at their common prefix, are that walk), and each node gets
the last token of its prefix from the nodes above it. So a prefix that a
thousand words share is encoded once. Words stay known until ``HELD_BYTES``
of them are held, then the memory starts anew. Tokens that end at a node come from an automaton
over the vocabulary, the longest first; which pairs of tokens are compatible
is worked out by merging, once per pair. A word's encoding is read off by
stepping back from its node, token by token.

Nothing is shuffled; a block bounds the memory; a recomputed task gives the
same rows. One text longer than a block is a block of its own.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; repeated rows are encoded as often as they come; a null id is kept; an
empty table gives an empty result; other columns are ignored. A text is
encoded whole, however long, also a single word or run of blanks of millions
of characters. A text that spells a special token gets that token's id, as
the tokenizer's own default is, or its ordinary pieces with
``specials=False``. Decoding ignores ids that the vocabulary lacks; bytes
that are no UTF-8 become replacement characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, per_worker

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: How a byte-level tokenizer splits text into words (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_BYTES = 4 << 20
HELD_BYTES = 4 << 20
#: Remembered pairs of tokens; beyond it the memory starts anew (a bound on
#: memory only: a forgotten pair is worked out again).
REMEMBERED = 1_000_000
NEVER = 1 << 40, 0  #: rank of a pair that does not merge


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, raw: str) -> None:
        import json

        spec = json.loads(raw)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        byte_of = byte_characters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.specials.values()])
        self.tokens: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            known = all(c in byte_of for c in token)
            self.tokens[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        own = {token: i for token, i in model["vocab"].items() if token not in self.specials}
        for content, i in self.specials.items():
            self.tokens[i] = content.encode()
        self.byte_id = [model["vocab"].get(c, -1) for c, _ in sorted(byte_of.items(), key=lambda p: p[1])]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[own[a], own[b]] = rank, own[a + b]
        self.mergeable = sorted(own.values())


class TrieEncoder:
    """Encodes sorted distinct words by a depth-first walk of their trie."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.tokens, self.merges, self.byte_id = vocabulary.tokens, vocabulary.merges, vocabulary.byte_id
        self.pairs: dict[int, bool] = {}
        self._automaton(vocabulary.mergeable)

    def _automaton(self, ids: list[int]) -> None:
        """States are prefixes of tokens; ``ends`` lists the tokens that are
        a suffix of a state, the longest first."""
        step, depth, token_at = {}, [0], [-1]
        for i in ids:
            state = 0
            for byte in self.tokens[i]:
                key = state << 8 | byte
                if key not in step:
                    step[key] = len(depth)
                    depth.append(depth[state] + 1)
                    token_at.append(-1)
                state = step[key]
            token_at[state] = i
        shorter, ends = [0] * len(depth), [()] * len(depth)
        for key in sorted(step, key=lambda k: depth[step[k]]):
            state, byte, parent = step[key], key & 255, key >> 8
            if parent:
                back = shorter[parent]
                while back and back << 8 | byte not in step:
                    back = shorter[back]
                shorter[state] = step.get(back << 8 | byte, 0)
            own = ((token_at[state], depth[state]),) if token_at[state] >= 0 else ()
            ends[state] = own + ends[shorter[state]]
        self.step, self.shorter, self.ends = step, shorter, ends

    def _next(self, state: int, byte: int) -> int:
        """Follow a byte; the answer is remembered as an edge of its own."""
        key, at = state << 8 | byte, state
        while at and at << 8 | byte not in self.step:
            at = self.shorter[at]
        found = self.step.get(at << 8 | byte, 0)
        self.step[key] = found
        return found

    def merged(self, text: bytes) -> list[int]:
        """Plain BPE of a short text: the lowest-ranked pair first."""
        merges = self.merges
        ids = [self.byte_id[b] for b in text]
        ranks = [merges.get(p, NEVER)[0] for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER[0]:
                break
            at = ranks.index(best)
            ids[at:at + 2] = [merges[ids[at], ids[at + 1]][1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = merges.get((ids[at], ids[at + 1]), NEVER)[0]
            if at:
                ranks[at - 1] = merges.get((ids[at - 1], ids[at]), NEVER)[0]
        return ids

    def _compatible(self, before: int, token: int) -> bool:
        if before < 0:
            return self.merged(self.tokens[token]) == [token]
        return self.merged(self.tokens[before] + self.tokens[token]) == [before, token]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, ids per word); words are sorted."""
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        step, ends, pairs = self.step, self.ends, self.pairs
        last, size, states, before = [-1], [0], [0], b""
        flat, counts = [], []
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:], states[shared + 1:]
            state = states[shared]
            for depth in range(shared, len(word)):
                byte = word[depth]
                state = step.get(state << 8 | byte, -1)
                if state < 0:
                    state = self._next(states[depth], byte)
                states.append(state)
                for token, n in ends[state]:
                    start = depth + 1 - n
                    key = (last[start] + 1) << 24 | token
                    good = pairs.get(key)
                    if good is None:
                        good = pairs[key] = self._compatible(last[start], token)
                    if good:
                        last.append(token)
                        size.append(n)
                        break
                else:
                    raise ValueError(f"the vocabulary cannot spell byte {byte}")
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            flat += ids
            counts.append(len(ids))
            before = word
        return np.array(flat, np.int32), np.array(counts, np.int64)


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each of the runs, end to end."""
    edge = np.cumsum(counts)
    return np.repeat(starts - (edge - counts), counts) + np.arange(edge[-1] if len(edge) else 0)


class Spelling:
    """The bytes of tokens."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, ids: np.ndarray, each: int = 1 << 18) -> bytes:
        """These tokens' bytes, end to end."""
        parts = (ids[k:k + each] for k in range(0, len(ids), each))
        return b"".join(self.bytes[gather(self.starts[p], self.lengths[p])].tobytes() for p in parts)


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word) -> int:
        self[word] = n = len(self)
        return n


class TextEncoder:
    """Ids of whole texts: words, their trie, ids put together again."""

    def __init__(self, raw: str) -> None:
        import regex

        vocabulary = Vocabulary(raw)
        self.specials, self.trie = vocabulary.specials, TrieEncoder(vocabulary)
        self.words = regex.compile(PATTERN).findall
        names = sorted(self.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(regex.escape(n) for n in names) + ")").split if names else None
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.held = Numbers(), 0
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _pieces(self, text: str, specials: bool) -> list:
        """Words, and ids of special tokens, in the order of the text."""
        if not specials or self.cut is None or not any(n in text for n in self.specials):
            return self.words(text)
        out: list = []
        for k, part in enumerate(self.cut(text)):
            out += [self.specials[part]] if k % 2 else self.words(part)
        return out

    def _learn(self) -> None:
        """Encode the words that have come since the last time."""
        new = list(islice(self.numbers, len(self.counts), None))
        spelled = [(w.encode(), k) for k, w in enumerate(new) if isinstance(w, str)]
        spelled.sort()
        flat, n = self.trie.encode([w for w, _ in spelled])
        fixed = [k for k, w in enumerate(new) if not isinstance(w, str)]
        order = np.array([k for _, k in spelled] + fixed, np.int64)
        flat = np.concatenate([flat, np.array([new[k] for k in fixed], np.int32)])
        n = np.concatenate([n, np.ones(len(fixed), np.int64)])
        counts = np.zeros(len(new), np.int64)
        counts[order] = n
        begin = np.zeros(len(new), np.int64)
        begin[order] = np.cumsum(n) - n
        self.flat = np.concatenate([self.flat, flat[gather(begin, counts)]])
        self.counts = np.concatenate([self.counts, counts])
        self.held += sum(len(w) for w, _ in spelled)

    def encode(self, texts: list[str | None], specials: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids per text)."""
        if self.held > HELD_BYTES:
            self._forget()
        number, at = self.numbers.__getitem__, []
        for text in texts:
            pieces = self._pieces(text, specials) if text else []
            at.append(np.fromiter(map(number, pieces), np.int32, len(pieces)))
        self._learn()
        per_text = np.array([len(a) for a in at], np.int64)
        at = np.concatenate([np.zeros(0, np.int32), *at])
        begin, counts = (np.cumsum(self.counts) - self.counts)[at], self.counts[at]
        edge = np.concatenate([[0], np.cumsum(counts)])
        return self.flat[gather(begin, counts)], np.diff(edge[np.concatenate([[0], np.cumsum(per_text)])])


def text_encoder(raw: str) -> TextEncoder:
    return per_worker(("trie", hash(raw)), lambda: TextEncoder(raw))


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()  # a vocabulary is a few megabytes; tasks get it from here


def blocks_of(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text, or one row."""
    sizes = np.array([0 if v is None else v for v in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held + n > most and i > lo:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def filled(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in blocks of about ``most`` bytes of text, so
    that words meet in few tries however the rows came."""
    held, size = [], 0
    for batch in batches:
        for part in blocks_of(batch, column, most):
            n = part.get_total_buffer_size() if part.num_rows == batch.num_rows else part.nbytes
            if held and size + n > most:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.concat_batches(held)


def spelling(raw: str) -> Spelling:
    return per_worker(("spelling", hash(raw)), lambda: Spelling(Vocabulary(raw).tokens))


def texts_of(ids: np.ndarray, counts: np.ndarray, spell: Spelling) -> list[str]:
    """The text that each run of ids spells; unknown ids (-1) spell nothing."""
    known = (ids >= 0) & (ids < len(spell.lengths))
    lengths = np.where(known, spell.lengths[np.where(known, ids, 0)], 0)
    spelled = spell(ids[known])
    edge = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [spelled[a:b].decode("utf-8", "replace") for a, b in zip(edge, edge[1:])]


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, specials: bool = True, with_decoded: bool = False,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of each row's whole text; ``with_decoded``
    adds the text that these ids decode to, as ``decode`` gives it, in the
    same pass."""
    raw = read_tokenizer(tokenizer)
    names = ["doc_id", "ids"] + (["decoded"] if with_decoded else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_encoder(raw)
        for block in filled(batches):
            ids, counts = coder.encode(block.column("text").to_pylist(), specials)
            edge = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            cols = [block.column("doc_id"), pa.ListArray.from_arrays(pa.array(edge), pa.array(ids))]
            if with_decoded:
                cols.append(pa.array(texts_of(ids, counts, spelling(raw)), pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names)

    return id_and_text(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>" + (", decoded string" if with_decoded else ""))


def decode(coded: DataFrame, tokenizer: str = TOKENIZER, ids: str = "ids") -> DataFrame:
    """The rows of ``coded`` with the text that its ids spell (the column
    ``text``; the other columns keep their names)."""
    raw = read_tokenizer(tokenizer)
    fields = [f for f in coded.schema.fields if f.name != "text"]
    schema = type(coded.schema)(list(fields)).add("text", "string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = spelling(raw)
        for batch in batches:
            lists = batch.column(ids)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = texts_of(values, counts, spell)
            cols = [batch.column(n) if n != "text" else pa.array(texts, pa.string()) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    return coded.select(*[F.col(f"`{f.name}`") for f in fields]).mapInArrow(run, schema)
