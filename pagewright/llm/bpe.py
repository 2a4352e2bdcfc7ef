"""BPE encoding and decoding: distinct words in a trie, encodings of shared prefixes computed once.

The encoding of a prefix is determined by its last token: it is the token t that ends there such that
t may follow the last token of the rest.  A depth-first walk over the trie of distinct words keeps the
last token of every prefix on the path, so a prefix that many words share is encoded once.  The end of
a word is a character of its own there, since merges treat a word's last character apart.

Texts are cut into words by the tokenizer file's own normalizer and pre-tokenizer, run on distinct
white-space-free pieces.  Null counts as empty: no tokens, the empty decoded text.  Strings of special
tokens in a text become those tokens, as in the library.  Rows repeat as given; an empty table gives an
empty result.  Pieces of any length are encoded in time linear in their length.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import held, portions

#: Fixed value: the characters with the Unicode property White_Space, which the normalizer turns into spaces.
WHITE = re.compile("[\t-\r \u0085   -     　]+")
#: Characters at which str.split() splits too, though they aren't white space here.
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Texts of Latin-1 letters and ASCII signs but ' can be lower-cased and cut by simple means; runs of signs are words there.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ\t-\r !-&(-~]*")
SIGNS = re.compile(r"[!-&(-/:-@\[-`{-~]+")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Model:
    """Merges and vocabulary of a BPE file, and what is worked out from them on demand."""

    def __init__(self, path: str, most_held: int = 700_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bpe = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.end: str = bpe.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = bpe["vocab"]
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(bpe["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.special_pattern = re.compile("|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.longest = max(len(t) for t in self.vocab)
        self.follows: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.most_held = most_held
        #: Ids of white-space-free pieces of text.
        self.pieces: dict[str, bytes] = {}
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [x for x in range(0x100) if x not in kept]
        #: The characters that stand for bytes.
        self.byte = {x: chr(x) for x in kept} | {x: chr(0x100 + k) for k, x in enumerate(others)}
        #: Whether this file cuts plain texts as we do, tried on every plain character, alone, beside letters and beside signs.
        every = [chr(x) for x in range(0x21, 0x100) if PLAIN.fullmatch(chr(x))]
        tried = " ".join([*every, *(f"B{c}b" for c in every), *(f"!{c}?" for c in every), *(f"7{c}7" for c in every)])
        self.plain = self.plainly(tried) == self.library.encode(tried, add_special_tokens=False).ids

    def symbols(self, token: str) -> list[str]:
        """The single symbols that a token is merged from."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """Plain BPE: merge the pair of lowest rank, leftmost first, until none is left."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def is_whole(self, token: str) -> bool:
        """Whether the token's own characters encode to it."""
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = token in self.vocab and self.merged(self.symbols(token)) == [token]
        return known

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart when their characters are encoded together."""
        if (known := self.follows.get((left, right))) is None:
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            known = self.follows[left, right] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
        return known

    def last_token(self, path: str, n: int, lasts: list[str], end: str) -> str:
        """The last token of the first n characters, given those of all shorter prefixes (lasts[k]: of k characters)."""
        vocab, whole, follows = self.vocab, self.whole, self.follows
        # exactly one token is right, so the likeliest are tried first: the last one grown by a character, that character
        if n > 1:
            grown = n - 1 - len(lasts[n - 1])
            token = path[grown:n] + end
            if whole.get(token) and (not grown or follows.get((lasts[grown], token))):
                return token
            token = path[n - 1 : n] + end
            if whole.get(token) and follows.get((lasts[n - 1], token)):
                return token
        for at in range(max(0, n - self.longest), n):
            token = path[at:n] + end
            if token in vocab and (whole.get(token) or self.is_whole(token)):
                if not at:
                    return token
                known = follows.get((lasts[at], token))
                if known or known is None and self.may_follow(lasts[at], token):
                    return token
        raise ValueError(f"no token for {path[n - 1 : n]!r}")

    def encode_words(self, words) -> dict[str, list[str]]:
        """Tokens of each distinct word, by one depth-first walk over their trie."""
        root: dict = {}
        for word in words:
            node = root
            for c in word:
                below = node.get(c)
                if below is None:
                    below = node[c] = {}
                node = below
            node[""] = word
        out: dict[str, list[str]] = {}
        last_token, end, cut = self.last_token, self.end, len(self.end)
        lasts, path = [""], ""
        todo = [(root, 0, "")]
        while todo:
            node, depth, c = todo.pop()
            if depth:
                path = path[: depth - 1] + c
                del lasts[depth:]
                word = node.pop("", None)
                if word is not None:
                    tokens = [last_token(path, depth, lasts, end)]
                    at = depth + cut - len(tokens[0])
                    while at:
                        tokens.append(lasts[at])
                        at -= len(lasts[at])
                    tokens.reverse()
                    out[word] = tokens
                if node:
                    lasts.append(last_token(path, depth, lasts, ""))
            depth += 1
            for c, below in node.items():
                todo.append((below, depth, c))
        return out

    def words(self, piece: str) -> list[str]:
        """The words of a piece without white space, each byte as the character that stands for it."""
        if piece.isalpha() and piece.islower() and PLAIN.fullmatch(piece):
            return [piece if piece.isascii() else "".join([self.byte[b] for b in piece.encode()])]
        normal = self.library.normalizer.normalize_str(piece) if self.library.normalizer else piece
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def plainly(self, text: str) -> list[int]:
        """The ids of a plain text, cut by simple means."""
        parts = SIGNS.sub(r" \g<0> ", text.lower()).split()
        self.learn(set(parts))
        return list(array("I", b"".join([self.pieces[p] for p in parts])))

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that are not held yet, in bounded portions."""
        if len(self.pieces) > self.most_held:
            self.pieces.clear()
        todo = list(pieces.difference(self.pieces))
        vocab = self.vocab
        for k in range(0, len(todo), 20_000):
            split = {p: self.words(p) for p in todo[k : k + 20_000]}
            # a trie has many nodes and no cycles: looking for cycles among them would take longer than the walk
            collecting = gc.isenabled()
            gc.disable()
            try:
                encoded = self.encode_words({w for ws in split.values() for w in ws})
            finally:
                if collecting:
                    gc.enable()
            for p, ws in split.items():
                tokens = encoded[ws[0]] if len(ws) == 1 else [t for w in ws for t in encoded[w]]
                self.pieces[p] = array("I", [vocab[t] for t in tokens]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text, its ids as little-endian unsigned 32-bit integers."""
        cut: list[list] = []
        for text in texts:
            if self.special and "<" in text and self.special_pattern.search(text):
                parts, at = [], 0
                for m in self.special_pattern.finditer(text):
                    parts += [WHITE.split(text[at : m.start()]), m[0]]
                    at = m.end()
                cut.append([*parts, WHITE.split(text[at:])])
            elif self.plain and PLAIN.fullmatch(text):
                cut.append([SIGNS.sub(r" \g<0> ", text.lower()).split()])
            else:
                cut.append([WHITE.split(text) if SEPARATORS.search(text) else text.split()])
        pieces: set[str] = set()
        for runs in cut:
            for run in runs:
                if not isinstance(run, str):
                    pieces.update(run)
        pieces.discard("")
        self.learn(pieces)
        known = self.pieces
        known[""] = b""
        return [b"".join([array("I", [self.special[run]]).tobytes() if isinstance(run, str) else b"".join(map(known.__getitem__, run)) for run in runs]) for runs in cut]

    def decode(self, ids: bytes) -> str:
        """As the library decodes a file that names no decoder: tokens joined by spaces."""
        return " ".join(map(self.token.__getitem__, array("I", ids)))


def encode_batches(path: str, make):
    """A mapInArrow function: make(ids of rows, encoded texts) gives each output batch."""

    def run(batches):
        model = held(f"bpe {path}", lambda: Model(path))
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in portions(texts, 4_000_000):
                yield make(ids[a:b], [(x, model.decode(x)) for x in model.encode(texts[a:b])])

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (list of int) and the decoded text of every document."""

    def make(ids, got):
        flat = np.frombuffer(b"".join(x for x, _ in got), "<u4").astype(np.int32)
        offsets = np.cumsum([0, *(len(x) // 4 for x, _ in got)]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, flat), pa.array([t for _, t in got], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode_batches(path, make), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and SHA-256 of ids and of the decoded text of every document."""

    def make(ids, got):
        rows = [(i, len(x) // 4, sha256(x).hexdigest(), sha256(t.encode()).hexdigest()) for i, (x, t) in zip(ids, got)]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode_batches(path, make), SCHEMA)
