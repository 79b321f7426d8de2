"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton's arcs carry tokens. It begins with one state and an arc for every base symbol, and each merge ``a b -> c``
adds one gadget: wherever ``p -a-> q -b-> r``, the state ``q`` is split for ``a`` into a copy without the arc ``b``, and
``p`` gets an arc ``c`` to ``r``. After all merges, a path spells a word by exactly the tokens that merging would leave.
All arcs of a token end in the same state, so a state is named by the token that leads to it; and since a gadget only
copies a state, drops one arc from the copy and adds one arc beside another, the transitions are tables of those
differences: for each token when it was made and from which parts, for each pair the merge that dropped the arc. Whether
a state has an arc is answered by following the differences back to the first state.

The arcs' labels are compiled into a table too: a trie of the tokens read backwards, from (node, byte) to node. A word is
read from left to right: the token that ends at each place is the one whose arc leaves the state of the token that ends
where it begins. There is exactly one, as the automaton is deterministic in the words it spells. All new words of a
slice move in step, one transition of all of them at a time; very long words are read one by one with the same tables.

Edge cases: a null or empty text has no tokens (digests of the empty string). Strings of special tokens in a text become
those tokens, as in the library. Repeated rows are encoded one by one; texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import presplit
from .bytewords import IntTable, Slice, map_text

FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
NEVER = 1 << 60
#: Words of at most so many symbols are read in step.
STEP_MOST = 64


class Automaton:
    """Compiled from a list of merges over a vocabulary, in order of rank."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.vocab, self.end = vocab, end
        size = max(vocab.values()) + 1
        self.label = [""] * size
        for token, i in vocab.items():
            self.label[i] = token
        self.made, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.dropped: dict[int, int] = {}
        whole = {a + b for a, b in merges}
        self.live = [token not in whole for token in self.label]
        self.size = size
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocab[a], vocab[b], vocab[a + b])
        self.by_label = {t: i for t, i in vocab.items() if self.live[i]}
        self.longest = max(len(t.removesuffix(end) if end else t) for t in vocab)
        self._compile()

    def _compile(self) -> None:
        """The tables as arrays: the differences, and the trie of the tokens read backwards."""
        self.letters = {c: k for k, c in enumerate(sorted({c for t in self.by_label for c in t}))}
        self.ends, self.wide = len(self.letters), 2 * len(self.letters) + 1  # a symbol at the end of a word is another one; the last one is no token's
        nodes: dict[int, int] = {}
        token = [-1]
        for label, i in self.by_label.items():
            bare = label.removesuffix(self.end) if self.end else label
            if not bare:
                continue
            shift, at = (self.ends if bare != label else 0), 0
            for c in reversed(bare):
                at = nodes.setdefault(at * self.wide + self.letters[c] + shift, len(nodes) + 1)
                shift = 0
                if at == len(token):
                    token.append(-1)
            token[at] = i
        table = lambda d: IntTable(np.fromiter(d.keys(), np.int64, len(d)), np.fromiter(d.values(), np.int64, len(d)))
        self.next, self.token, self.drops = table(nodes), np.array(token), table(self.dropped)
        self.made_at, self.parts = np.array(self.made), (np.array(self.left), np.array(self.right))

    def _gadget(self, rank: int, a: int, b: int, c: int) -> None:
        if not (self.live[a] and self.live[b]) or self.made[c] >= 0 or not self._arc(a, b, rank):
            return  # no path has a then b: the merge never applies
        if max(self.made[a], self.made[b]) >= rank:
            raise ValueError("a merge stands before those that make its parts")
        self.made[c], self.left[c], self.right[c], self.live[c] = rank, a, b, True
        self.dropped[a * self.size + b] = rank

    def _arc(self, t: int, u: int, when: int) -> bool:
        """Whether, just before the merge ``when``, the state that ``t`` leads to has an arc ``u``."""
        made, size, least = self.made, self.size, when
        while True:
            if self.dropped.get(t * size + u, NEVER) < least:
                return False
            if made[t] < 0 and made[u] < 0:
                return True
            if made[t] > made[u]:
                # t's state was copied from that of its right part when t was made
                least, t = made[t], self.right[t]
            else:
                # the arc u was added beside the arc of its left part, in states that still had that after the split
                least, u = made[u] + 1, self.left[u]

    def arc(self, t: int, u: int) -> bool:
        return self._arc(t, u, NEVER)

    def has_arcs(self, t: np.ndarray, u: np.ndarray) -> np.ndarray:
        """:meth:`arc` of many pairs at a time."""
        out, left = np.zeros(len(t), bool), np.arange(len(t))
        t, u, least = t.copy(), u.copy(), np.full(len(t), NEVER)
        while len(left):
            alive = self.drops.get(t * self.size + u, NEVER) >= least
            mt, mu = self.made_at[t], self.made_at[u]
            first = (mt < 0) & (mu < 0)
            out[left[alive & first]] = True
            go = alive & ~first
            left, t, u, mt, mu = left[go], t[go], u[go], mt[go], mu[go]
            back = mt > mu
            least = np.where(back, mt, mu + 1)
            t, u = np.where(back, self.parts[1][t], t), np.where(back, u, self.parts[0][u])
        return out

    def encode(self, word: str) -> list[int]:
        """The tokens of one pre-split word, given in the vocabulary's alphabet."""
        n, get, longest = len(word), self.by_label.get, self.longest
        last, since = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            shown = word if i < n else word + self.end
            stop = len(shown) if i == n else i
            for j in range(i - 1, max(-1, i - longest - 1), -1):
                u = get(shown[j:stop])
                if u is None or j and not (last[j] >= 0 and self._arc(last[j], u, NEVER)):
                    continue
                last[i], since[i] = u, j
                break
        out = []
        i = n
        while i:
            if last[i] < 0:
                raise ValueError("the vocabulary lacks a base symbol")
            out.append(last[i])
            i = since[i]
        out.reverse()
        return out

    def encode_many(self, words: Sequence[str]) -> list[list[int]]:
        """:meth:`encode` of each word, all in step."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > STEP_MOST).tolist():
            out[k] = self.encode(words[k])
        order = np.flatnonzero((sizes > 0) & (sizes <= STEP_MOST))
        order = order[np.argsort(-sizes[order], kind="stable")]
        if not len(order):
            return out
        sizes = sizes[order]
        begin = np.cumsum(sizes) - sizes
        codes = np.frombuffer("".join([words[k] for k in order.tolist()]).encode("utf-32-le"), np.uint32)
        known, at = np.unique(codes, return_inverse=True)
        symbols = np.array([self.letters.get(chr(c), self.wide - 1) for c in known.tolist()])[at]
        if self.end:
            symbols[begin + sizes - 1] += np.where(symbols[begin + sizes - 1] < self.ends, self.ends, 0)
        last = np.full((int(sizes[0]) + 1, len(sizes)), -1, np.int64)
        since = np.zeros_like(last)
        for i in range(1, int(sizes[0]) + 1):
            word = np.arange(int(np.searchsorted(-sizes, -i, "right")))  # those of i symbols or more
            node = np.zeros(len(word), np.int64)
            for j in range(i - 1, max(-1, i - self.longest - 1), -1):
                node = self.next.get(node * self.wide + symbols[begin[word] + j], 0)
                word, node = word[node > 0], node[node > 0]
                if not len(word):
                    break
                u = self.token[node]
                ok = u >= 0
                if j:
                    t = last[j, word]
                    ok &= t >= 0
                    tried = np.flatnonzero(ok)
                    ok[tried] = self.has_arcs(t[tried], u[tried])
                last[i, word[ok]], since[i, word[ok]] = u[ok], j
                word, node = word[~ok], node[~ok]
        tokens: list[list[int]] = [[] for _ in range(len(sizes))]
        ends, word = sizes.copy(), np.arange(len(sizes))
        while len(word):
            u = last[ends[word], word]
            if (u < 0).any():
                raise ValueError("the vocabulary lacks a base symbol")
            for k, x in zip(word.tolist(), u.tolist(), strict=True):
                tokens[k].append(x)
            ends[word] = since[ends[word], word]
            word = word[ends[word] > 0]
        for k, found in zip(order.tolist(), tokens, strict=True):
            out[k] = found[::-1]
        return out

    def decode(self, ids: Sequence[int]) -> list[str]:
        return [self.label[i] for i in ids]


class WordTokenizer:
    """A tokenizer file of the kind with word ends: normalise, pre-split, then the automaton for each distinct word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], pairs, model["end_of_word_suffix"] or "")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.library = Tokenizer.from_file(path)  # for the normaliser and pre-tokenizer of wide texts only
        self.alphabet = presplit.byte_alphabet()
        self.names = list(self.automaton.label)
        for token, i in self.special.items():
            self.names.extend([""] * (i + 1 - len(self.names)))
            self.names[i] = token
        self.digits = [str(i) for i in range(len(self.names))]
        self.pieces = presplit.Pieces(self._entries)

    def _entry(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        digits, names = self.digits, self.names
        return len(ids), " ".join([digits[i] for i in ids]).encode(), " ".join([names[i] for i in ids]).encode()

    def _entries(self, words: list[bytes]) -> list:
        alphabet = self.alphabet
        # printable ASCII stands for itself in the alphabet
        shown = [w.decode() if w.isascii() and w.decode().isprintable() else "".join([alphabet[b] for b in w]) for w in words]
        return [self._entry(ids) for ids in self.automaton.encode_many(shown)]

    def encode_text(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for m in [*(self.cut.finditer(text) if self.cut else ()), None]:
            segment = text[at : m.start() if m else len(text)]
            if segment:
                pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(segment))]
                out += [i for ids in self.automaton.encode_many(pieces) for i in ids]
            if m:
                out.append(self.special[m.group()])
                at = m.end()
        return out

    def encode_slice(self, part: Slice) -> list[list[tuple[int, bytes, bytes]]]:
        """For each text the entries of its pieces: number of tokens, their ids in decimal, their labels, both joined by a space."""
        narrow = presplit.narrow_rows(part)
        low = presplit.latin_lower(part.buf)
        starts, ends, places = presplit.split(part, low, spaced=False)
        entries, back = self.pieces.entries(part, low, starts, ends)
        back = back.tolist()
        whole = part.buf.tobytes()
        specials = [s.encode() for s in self.special]
        rare = any(s in whole for s in specials)
        out = []
        for i in range(part.n):
            if not narrow[i] or rare and any(s in part.text(i) for s in specials):
                out.append([self._entry(self.encode_text(part.text(i).decode()))])
            else:
                out.append([entries[k] for k in back[places[i] : places[i + 1]]])
        return out


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """Compiled once per Python process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(df: DataFrame, path: str | None = None, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the column ``ids``."""

    def make():
        model = tokenizer(path or default_path())
        return lambda part, _: {"ids": [[int(i) for e in es for i in e[1].split()] for es in model.encode_slice(part)]}

    return map_text(df, text, keep, "ids array<int>", make)


def decode(df: DataFrame, path: str | None = None, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the column ``decoded``: arc labels joined by a space. Null ids decode to null."""
    schema = df.select(*keep).schema.add("decoded", "string")
    names = [*keep, ids]

    def run(batches):
        model = tokenizer(path or default_path())
        for b in batches:
            texts = [None if x is None else " ".join([model.names[i] for i in x]) for x in b.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(names.index(c)) for c in keep], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return df.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def digests(df: DataFrame, path: str | None = None, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and, per row, the number of tokens, the digest of its ids and of the text they decode to."""

    def make():
        model = tokenizer(path or default_path())

        def compute(part: Slice, _) -> dict:
            rows = [[e for e in es if e[0]] for es in model.encode_slice(part)]
            return {
                "n_tokens": [sum([e[0] for e in es]) for es in rows],
                "ids_sha256": [hashlib.sha256(b" ".join([e[1] for e in es])).hexdigest() for es in rows],
                "decoded_sha256": [hashlib.sha256(b" ".join([e[2] for e in es])).hexdigest() for es in rows],
            }

        return compute

    return map_text(df, text, keep, FIELDS, make)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
