"""Token ids of texts by public vocabularies whose files are installed on every executor."""

import base64
import json
import re
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import regex

#: Characters that the normalizer of the word vocabulary leaves alone but for case: below the
#: combining marks, without the control characters that libraries class differently.
NOT_PLAIN = re.compile("[^\t-\r -\u024f\u2010-\u2027]")
#: How the word vocabulary splits texts (fixed by its file).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
CACHED_WORDS = 300_000
LONGEST_CACHED = 64
JOINED_WORDS = 1 << 13
#: Ends a piece. Plain texts do not hold it.
END = "\x00"


def vocabulary_bytes(tokens: dict[str, int]) -> dict[bytes, int]:
    """Ids of the tokens as bytes, those at the end of a piece followed by END.

    Byte-level vocabularies write each byte as a character: itself where it is printable Latin-1,
    else the next one from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    out = {}
    for token, i in tokens.items():
        last = token.endswith("</w>")
        body = token.removesuffix("</w>") if last else token
        out[bytes(byte[c] for c in body) + END.encode() * last] = i
    return out


class WordBpe:
    """Ids by a ``tokenizers`` file, as little-endian 32-bit numbers.

    Words between white space of plain texts are encoded once and looked up after that: neither a
    piece nor a merge crosses white space, so the ids of a text are those of its words in turn. New
    words are encoded by the faster of the two libraries, which merges by rank of the joined bytes
    instead of the rank of a pair. Both come to the same ids if ``reaches_itself`` holds for the
    file. Other texts, and texts in which a special token is spelt out, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        added = {t["content"] for t in known["added_tokens"]}
        self.path, self.special = path, sorted(added)
        tokens = {t: i for t, i in known["model"]["vocab"].items() if t not in added}
        self.fast = tiktoken.Encoding(
            "words",
            pat_str=f"[^{END}]+{END}",
            mergeable_ranks=vocabulary_bytes(tokens),
            special_tokens={},
        )
        self.ends = np.zeros(max(tokens.values()) + 1, bool)
        self.ends[[i for token, i in tokens.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        words: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if not NOT_PLAIN.search(text) and not any(s in text for s in self.special):
                words[i] = text.lower().split()
        other = [i for i in range(len(texts)) if i not in words]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = list(set(chain.from_iterable(words.values())).difference(self.known))
        for at in range(0, len(new), JOINED_WORDS):
            part = new[at : at + JOINED_WORDS]
            self.known.update(zip(part, self.encode_words(part)))
        look = self.known.__getitem__
        for i, found in words.items():
            out[i] = b"".join(map(look, found))
        for word in new:
            if len(word) > LONGEST_CACHED:
                del self.known[word]
        for i in other:
            out[i] = self.library(texts[i])
        return out

    def forget(self) -> None:
        """Drop the words encoded so far, so that a worker process that waits does not hold them."""
        self.known = {}

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, told apart by counting the tokens that end a piece."""
        pieces = [[w] if w.isalpha() else PIECE.findall(w) for w in words]
        joined = END.join(chain.from_iterable(pieces)) + END
        ids = self.fast.encode_to_numpy(joined, disallowed_special=())
        last = np.flatnonzero(self.ends[ids]) + 1
        cuts = 4 * last[np.cumsum([len(p) for p in pieces]) - 1]
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]

    @cached_property
    def whole(self):
        """The library's own encoder, made when a text first needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def reaches_itself(path: str) -> bool:
    """Whether each token of a ``tokenizers`` file comes out of its own characters by the file's
    merges, and ids rise with the merges.

    Then merging by pairs and by joined bytes agree. Where two neighbouring tokens make up a token
    t, no merge has crossed the ends of t so far, so t's characters were merged as they would be
    alone; alone they become t, and the only state of two tokens on that way is the pair whose
    merge makes t. So a pair that joins to a token is always that token's own merge.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    rank = {tuple(pair): k for k, pair in enumerate(model["merges"])}
    vocabulary, made = model["vocab"], ["".join(pair) for pair in model["merges"]]
    ids = [vocabulary[token] for token in made]
    if ids != sorted(set(ids)) or min(ids) < len(vocabulary) - len(ids) - 2:
        return False
    for token in made:
        body = token.removesuffix("</w>")
        parts = list(body[:-1]) + [body[-1] + token[len(body) :]]
        while len(parts) > 1:
            best, at = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == len(rank):
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


@lru_cache(4)
def word_bpe(path: str) -> WordBpe:
    """One encoder for each worker process."""
    return WordBpe(path)


@lru_cache(4)
def byte_bpe(path: str):
    """A ``tiktoken`` encoder of a file of ranks, one for each worker process."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
