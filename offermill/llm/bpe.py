"""Byte-pair tokenizers compiled to finite-state machines.

Two deterministic transducers in a row replace the tokenizer's search:

* `Splitter` walks over character classes and marks where words begin. A text is cut into chunks
  that are walked side by side. Where a chunk's entry state is not known, its map from every entry
  state to the exit state is computed; the maps compose through a parallel prefix scan, which gives
  each chunk its entry state. Maps become constant after a few characters, from where on one state
  is followed.
* `Merger` walks over the bytes of words. It is the automaton of the vocabulary's trie, annotated
  with the tokens that end at each node; a step emits the change in the number of tokens of the text
  so far. The encoding of a prefix has exactly one last token: the one that stands unmerged behind the
  last token of the prefix before it. Which tokens stand behind which is worked out from the merge
  ranks when a text first needs it, and kept in a table of fixed size.

Both walk over many chunks or words at once with array operations. The tables come from the
tokenizer file; which code points count as letters, numbers and blanks is asked of the library.
"""

from __future__ import annotations

import functools
import json
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import regex

SLOT_BITS = 21
_MIX = 0x9E3779B97F4A7C1
LANE = 512
ROW_WORDS = 5  # of 64 bits: 256 bytes and the closing mark

# Character classes.
END, SPACE, BLANK, NUMBER, OTHER, APOSTROPHE, LETTER = range(7)
_SHORT = "strevmld"  # letters of contractions, each a class of its own
SYMBOLS = LETTER + 1 + len(_SHORT)

# States of the splitter.
FRESH, IN_LETTERS, IN_NUMBER, IN_OTHER, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK = range(12)
STATES = 12
BEFORE, BEFORE_PREVIOUS = 1, 2  # outputs: a word begins at this character, at the one before


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def class_table(path: str) -> bytes:
    """The class of each code point as the library sees it, compressed."""
    from tokenizers import Tokenizer, pre_tokenizers

    table = np.full(0x110000, OTHER, np.uint8)
    everything = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, everything))
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    Tokenizer.from_file(path)  # a missing file should fail here, not in a task

    def joined(kind: str, neighbour: str) -> np.ndarray:
        """Those of a kind that the library keeps in one word with a neighbour of the kind."""
        asked = [ord(c) for c in regex.findall(rf"\p{{{kind}}}", text)]
        begins = {a for _, (a, _) in split.pre_tokenize_str("".join(f"{neighbour}{chr(c)}\n" for c in asked))}
        return np.array([c for k, c in enumerate(asked) if 3 * k + 1 not in begins])

    table[joined("L", "a")] = LETTER
    table[joined("N", "1")] = NUMBER
    table[[ord(c) for c in regex.findall(r"\s", text)]] = BLANK
    table[32], table[39] = SPACE, APOSTROPHE
    for k, c in enumerate(_SHORT):
        table[ord(c)] = LETTER + 1 + k
    return zlib.compress(table.tobytes())


@functools.lru_cache(maxsize=2)
def _splitter_tables(join_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Next states and outputs, for words that take a blank before them or drop all blanks."""
    letters = range(LETTER, SYMBOLS)
    short = {c: LETTER + 1 + k for k, c in enumerate(_SHORT)}
    fresh = {SPACE: ONE_SPACE, BLANK: ONE_BLANK, NUMBER: IN_NUMBER, OTHER: IN_OTHER, APOSTROPHE: QUOTE, END: FRESH}
    fresh |= {s: IN_LETTERS for s in letters}
    step = {(q, s): (fresh[s], BEFORE) for q in range(STATES) for s in range(SYMBOLS)}
    for s in letters:
        step[IN_LETTERS, s] = (IN_LETTERS, 0)
    if join_space:
        step[IN_NUMBER, NUMBER] = (IN_NUMBER, 0)
    for q in (IN_OTHER, QUOTE):
        for s in (OTHER, APOSTROPHE):
            step[q, s] = (IN_OTHER, 0)
    for c in "stmd":
        step[QUOTE, short[c]] = (FRESH, 0)
    for c, q, closing in (("r", QUOTE_R, "e"), ("v", QUOTE_V, "e"), ("l", QUOTE_L, "l")):
        step[QUOTE, short[c]] = (q, 0)
        for s in range(SYMBOLS):  # no contraction: a word of letters began at the character before
            to, out = step[IN_LETTERS, s]
            step[q, s] = (to, out | BEFORE_PREVIOUS)
        step[q, short[closing]] = (FRESH, 0)
    if join_space:
        joined = {**fresh, APOSTROPHE: IN_OTHER}
        for q in (ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK):
            many = BEFORE_PREVIOUS if q in (MANY_SPACE, MANY_BLANK) else 0
            for s in range(SYMBOLS):
                if s == SPACE or s == BLANK:
                    step[q, s] = (MANY_SPACE if s == SPACE else MANY_BLANK, 0)
                elif s == END:
                    step[q, s] = (FRESH, BEFORE)
                elif q in (ONE_SPACE, MANY_SPACE):  # the last blank of the run belongs to the word
                    step[q, s] = (joined[s], many)
                else:
                    step[q, s] = (fresh[s], many | BEFORE)
    to, out = np.zeros(STATES * SYMBOLS, np.uint8), np.zeros(STATES * SYMBOLS, np.uint8)
    for (q, s), (t, o) in step.items():
        to[q * SYMBOLS + s], out[q * SYMBOLS + s] = t, o
    return to, out


def word_begins(symbols: np.ndarray, join_space: bool) -> np.ndarray:
    """Where words begin in a stream of classes; every text in it ends with END."""
    to, out = _splitter_tables(join_space)
    n = len(symbols)
    lanes = -(-n // LANE)
    stream = np.zeros(lanes * LANE, np.uint8)
    stream[:n] = symbols
    columns = np.ascontiguousarray(stream.reshape(lanes, LANE).T)
    outputs = np.empty((LANE, lanes), np.uint8)
    # Maps of the chunks, until no entry state matters any more.
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[None], lanes, axis=0)
    known = LANE
    for k in range(LANE):
        maps = to[maps.astype(np.int32) * SYMBOLS + columns[k][:, None]]
        if k % 4 == 3 and (maps == maps[:, :1]).all():
            known = k + 1
            break
    state = maps[:, 0].astype(np.int32)
    for k in range(known, LANE):
        at = state * SYMBOLS + columns[k]
        outputs[k] = out[at]
        state = to[at].astype(np.int32)
    if known < LANE:
        maps = np.repeat(state.astype(np.uint8)[:, None], STATES, axis=1)
    gap = 1
    while gap < lanes and not (maps == maps[:, :1]).all():  # prefix scan by doubling
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].astype(np.int64), axis=1)
        gap *= 2
    state = np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.int32)
    for k in range(known):
        at = state * SYMBOLS + columns[k]
        outputs[k] = out[at]
        state = to[at].astype(np.int32)
    marks = np.ascontiguousarray(outputs.T).reshape(-1)[: n + 1]
    begins = (marks[:n] & BEFORE) > 0
    begins[:-1] |= (marks[1:n] & BEFORE_PREVIOUS) > 0
    return begins


class Merger:
    """The machine over the bytes of words, and over a closing mark if the vocabulary knows ends of words.

    Its state is a node of the token trie, the longest one that ends here, and the last tokens of the
    shorter prefixes. A step follows one transition of the trie; of the tokens that end here, longest
    first, the one that stands behind the last token of the prefix before it becomes the last token, and
    the count of emitted tokens is that prefix's count plus one.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        suffix, vocab, letters = model.get("end_of_word_suffix") or "", model["vocab"], _byte_letters()
        self.mark = bool(suffix)
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens a token is merged from
        self.ranks: dict[int, int] = {}  # when it is merged; bytes come first
        self.merges: dict[tuple[int, int], int] = {}
        spelled: dict[int, tuple[int, ...]] = {}
        for letter, byte in letters.items():
            spelled[vocab[letter]] = (byte,)
            if suffix:
                spelled[vocab[letter + suffix]] = (byte, 256)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merges[left, right] = rank
            self.parts[whole], self.ranks[whole] = (left, right), rank
            spelled[whole] = spelled[left] + spelled[right]
        self._build(spelled, max(vocab.values()) + 1)
        self.sound: dict[int, bool] = {}
        self.slots = np.full(1 << SLOT_BITS, -1, np.int64)
        self.stands = np.zeros(1 << SLOT_BITS, bool)

    def _build(self, spelled: dict[int, tuple[int, ...]], tokens: int) -> None:
        children: list[dict[int, int]] = [{}]
        token_at = [-1]
        for token, symbols in spelled.items():
            node = 0
            for s in symbols:
                if s not in children[node]:
                    children[node][s] = len(children)
                    children.append({})
                    token_at.append(-1)
                node = children[node][s]
            token_at[node] = token
        self.longest = np.full(len(children), -1, np.int32)  # longest token that ends at a node
        self.shorter = np.full(tokens, -1, np.int32)  # next longest one
        self.length = np.zeros(tokens, np.int32)
        for token, symbols in spelled.items():
            self.length[token] = len(symbols)
        # Most transitions are those of the root. Of each node only the others are kept, in rows that
        # nodes without children share with the node of their longest proper ending.
        self.root = np.zeros(64 * ROW_WORDS, np.int32)
        for s, child in children[0].items():
            self.root[s] = child
        self.row = np.zeros(len(children), np.int32)
        symbols, targets, sizes = array("H"), array("i"), [0]
        begins = [0]
        shorter_node = [0] * len(children)
        queue = [0]
        for node in queue:  # breadth first
            back = shorter_node[node]
            below = self.longest[back] if node else -1
            token = token_at[node]
            self.longest[node] = token if token >= 0 else below
            if token >= 0:
                self.shorter[token] = below
            if not node:
                queue += children[0].values()
                continue
            at = begins[self.row[back]]
            known = dict(zip(symbols[at : at + sizes[self.row[back]]], targets[at : at + sizes[self.row[back]]]))
            if not children[node]:
                self.row[node] = self.row[back]
                continue
            for s, child in children[node].items():
                shorter_node[child] = known[s] if s in known else int(self.root[s])
                queue.append(child)
            known.update(children[node])
            self.row[node] = len(sizes)
            begins.append(len(symbols))
            sizes.append(len(known))
            listed = sorted(known)
            symbols.extend(listed)
            targets.extend(known[s] for s in listed)
        self._pack(np.array(sizes), np.frombuffer(symbols, np.uint16).astype(np.int64), np.frombuffer(targets, np.int32))

    def _pack(self, sizes: np.ndarray, symbols: np.ndarray, targets: np.ndarray) -> None:
        """Rows as bit sets of their symbols; the place of a target is the number of bits before its own."""
        word = np.repeat(np.arange(len(sizes)) * ROW_WORDS, sizes) + (symbols >> 6)
        self.bits = np.zeros(len(sizes) * ROW_WORDS, np.uint64)
        np.bitwise_or.at(self.bits, word, np.uint64(1) << (symbols & 63).astype(np.uint64))
        numbers = np.bitwise_count(self.bits).astype(np.int64)
        self.before = (np.cumsum(numbers) - numbers).astype(np.int32)
        self.targets = np.append(targets, np.int32(0))

    def _goto(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        at = self.row[node] * ROW_WORDS + (symbol >> 6)
        bits, bit = self.bits[at], np.uint64(1) << (symbol & 63).astype(np.uint64)
        place = self.before[at] + np.bitwise_count(bits & (bit - np.uint64(1)))
        return np.where(bits & bit > 0, self.targets[place], self.root[symbol])

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The outermost parts of a token on one side, each with the rank that consumes it."""
        out = [(token, float("inf"))]
        while token in self.parts:
            rank, token = self.ranks[token], self.parts[token][side]
            out.append((token, rank))
        return out

    def _first_merge(self, left: int, right: int) -> float:
        """The rank of the earliest merge across the border of two tokens; infinite if there is none.

        Parts merge across when both are still whole. Equal pairs merge from the left.
        """
        best = float("inf")
        heads = self._edge(right, 0)
        for a, until_a in self._edge(left, 1):
            for b, until_b in heads:
                rank = self.merges.get((a, b))
                if rank is not None and rank < until_a and rank <= until_b:
                    best = min(best, rank)
        return best

    def _is_sound(self, token: int) -> bool:
        """Whether the spelling of a token is encoded as this token."""
        known = self.sound.get(token)
        if known is None:
            known = True
            if token in self.parts:
                left, right = self.parts[token]
                known = self._is_sound(left) and self._is_sound(right) and self._first_merge(left, right) >= self.ranks[token]
            self.sound[token] = known
        return known

    def _allowed(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether tokens stay unmerged behind the tokens before them (-1: at the begin of a word)."""
        key = (before.astype(np.int64) + 1) << 20 | token
        slot = (key * _MIX >> (62 - SLOT_BITS)) & ((1 << SLOT_BITS) - 1)
        missing = np.flatnonzero(self.slots[slot] != key)
        if not len(missing):
            return self.stands[slot]
        out = self.stands[slot]
        for k, at, back in _grouped(key[missing], slot[missing]):
            left, right = (k >> 20) - 1, k & 0xFFFFF
            found = self._is_sound(right) and (left < 0 or self._is_sound(left) and self._first_merge(left, right) == float("inf"))
            self.slots[at], self.stands[at] = k, found
            out[missing[back]] = found
        return out

    def walk(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words data[begins:ends]: the numbers of tokens; the last tokens of all prefixes, by
        place of their last byte; the last tokens of the whole words."""
        order = np.argsort(begins - ends, kind="stable")
        begin, length = begins[order], (ends - begins)[order]
        steps = length + self.mark
        node = np.zeros(len(order), np.int32)
        last, counts = np.full(len(data) + 1, -1, np.int32), np.zeros(len(data) + 1, np.int32)
        whole, total = np.full(len(order), -1, np.int32), np.zeros(len(order), np.int64)
        most = int(steps[0]) if len(steps) else 0
        active = np.searchsorted(-steps, -np.arange(1, most + 1), side="right")
        for k, m in enumerate(active):
            at = begin[:m] + k
            symbol = data[at].astype(np.int32)
            closing = steps[:m] == k + 1
            if self.mark:
                symbol[closing] = 256
            node[:m] = self._goto(node[:m], symbol)
            token, count = np.empty(m, np.int32), np.empty(m, np.int32)
            todo, guess = np.arange(m), self.longest[node[:m]]
            while len(todo):
                reach = k + 1 - self.length[guess]
                place = begin[todo] + reach - 1
                first = reach == 0
                before = np.where(first, -1, last[place])
                good = self._allowed(before, guess)
                done = todo[good]
                token[done] = guess[good]
                count[done] = np.where(first, 0, counts[place])[good] + 1
                todo, guess = todo[~good], self.shorter[guess[~good]]
            whole[:m][closing], total[:m][closing] = token[closing], count[closing]
            if self.mark:
                at, token, count = at[~closing], token[~closing], count[~closing]
            last[at], counts[at] = token, count
        numbers, tokens = np.empty(len(order), np.int64), np.empty(len(order), np.int32)
        numbers[order], tokens[order] = total, whole
        return numbers, last, tokens

    def tokens(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the words one after another, words in the order of their places, and how many each has."""
        numbers, last, token = self.walk(data, begins, ends)
        out = np.empty(int(numbers.sum()), np.int32)
        behind = np.cumsum(numbers)
        word, left, place = np.arange(len(numbers)), behind - 1, ends + self.mark
        while len(word):  # from the last token of each word back to its first
            out[left] = token
            place = place - self.length[token]
            more = place > begins[word]
            word, left, place = word[more], left[more] - 1, place[more]
            token = last[place - 1]
        return out, numbers


def _grouped(keys: np.ndarray, slots: np.ndarray):
    """Distinct keys with their slots and the places that have them."""
    values, first, back = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(back, kind="stable")
    cuts = np.searchsorted(back[order], np.arange(len(values) + 1))
    for k, value in enumerate(values.tolist()):
        yield value, int(slots[first[k]]), order[cuts[k] : cuts[k + 1]]


_LOADED: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    """The machine of a worker process; what one task compiled serves the next."""
    if path not in _LOADED:
        _LOADED[path] = Merger(path)
    return _LOADED[path]


@dataclass
class Stream:
    """Texts in a row, each followed by one closing byte, with the words found in them."""

    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # number of the text of each word


def split_words(texts: list[str], classes: np.ndarray, join_space: bool) -> Stream:
    whole = "\0".join(texts) + "\0"
    data = np.frombuffer(whole.encode(), np.uint8)
    if len(data) == len(whole):
        points, offsets = data, None
    else:
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        sizes = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    closing = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    symbols = classes[points]
    symbols[closing] = END
    at = np.flatnonzero(word_begins(symbols, join_space))
    until = np.concatenate([at[1:], [len(symbols)]])
    kind = symbols[at]
    real = kind != END
    if not join_space:
        real &= (kind != SPACE) & (kind != BLANK)
    at, until = at[real], until[real]
    text = np.searchsorted(closing, at)
    if offsets is not None:
        at, until = offsets[at], offsets[until]
    return Stream(data, at, until, text)
