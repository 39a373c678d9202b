"""Token counts by dynamic programming that shares the prefixes of a trie.

A text's pre-tokens are its words between white space, each with a leading
word-start mark. Its tokens are those of the best segmentation into vocabulary
pieces under a unigram model; a character that no piece covers costs a penalty
and counts as one token for each of its UTF-8 bytes. The distinct pre-tokens of
a batch are walked in sorted order, which is the order of their trie: forward
scores of a shared prefix are computed once and each terminal stores its count.
Counts of pre-tokens are kept within a task, up to a bound, so nothing is
shuffled and memory does not follow the input.

The vocabulary is a public tokenizer's file, whose path is a parameter and which
the driver reads. Where the file holds merge ranks in place of log
probabilities, a piece of rank r gets those of Zipf's law, -log(r + 2.7).

Cases: null and empty texts count 0 words and 0 tokens; rows are counted alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .common import map_texts, table

MARK = "▁"
#: Of pre-tokens whose counts a task keeps.
KEPT = 400_000
#: Characters of the words whose counts are kept, and of a word that is counted by itself.
KEPT_CHARS, LONG = 1 << 24, 1 << 12


@dataclass
class Vocabulary:
    scores: dict[str, float]
    unknown: float

    def __post_init__(self):
        ends: dict[str, set[int]] = {}
        for p in self.scores:
            ends.setdefault(p[-2:], set()).add(len(p))
        self.ends = ends
        self.sizes: dict[str, tuple[int, ...]] = {}

    def sizes_before(self, suffix: str) -> tuple[int, ...]:
        """Lengths of the pieces that end as ``suffix``, two characters, does; kept between calls."""
        if len(self.sizes) > 1 << 16:
            self.sizes.clear()
        found = self.ends.get(suffix, set()) | ({1} if suffix[-1] in self.scores else set())
        self.sizes[suffix] = tuple(sorted(found))
        return self.sizes[suffix]


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    raw = {model.id_to_piece(i): model.get_score(i) for i in plain}
    if raw and all(float(s).is_integer() for s in raw.values()):
        raw = {p: -math.log(2.7 - s) for p, s in raw.items()}
    return Vocabulary(raw, min(raw.values(), default=0.0) - 10.0)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_sorted(words: list[str], vocabulary: Vocabulary) -> dict[str, int]:
    """Tokens of each of the distinct, sorted ``words``; scores of shared prefixes are reused."""
    scores, unknown, sizes = vocabulary.scores, vocabulary.unknown, vocabulary.sizes
    get = scores.get
    best, count = [0.0], [0]  # of the prefixes of the word at hand
    last, out = "", {}
    for word in words:
        s = MARK + word
        most = min(len(s), len(last))
        k = 0
        if s[:most] == last[:most]:
            k = most
        else:
            while s[k] == last[k]:
                k += 1
        del best[k + 1 :], count[k + 1 :]
        for i in range(k + 1, len(s) + 1):
            top, n = -math.inf, 0
            suffix = s[i - 2 : i] if i > 1 else s[:1]
            for size in sizes.get(suffix) or vocabulary.sizes_before(suffix):
                if size > i:
                    break
                piece = get(s[i - size : i])
                if piece is not None and (x := best[i - size] + piece) > top:
                    top, n = x, count[i - size] + 1
            if s[i - 1] not in scores and (x := best[i - 1] + unknown) > top:
                top, n = x, count[i - 1] + len(s[i - 1].encode("utf-8", "replace"))
            best.append(top)
            count.append(n)
        last = s
        out[word] = count[-1]
    return out


def count_long(word: str, vocabulary: Vocabulary) -> int:
    """Tokens of one word of any length: only the last prefixes that a piece can reach back to are held."""
    scores, unknown, sizes = vocabulary.scores, vocabulary.unknown, vocabulary.sizes
    reach = max(map(len, scores), default=1) + 1
    s = MARK + word
    best, count = [0.0] * reach, [0] * reach  # of prefix i at i modulo reach
    for i in range(1, len(s) + 1):
        top, n = -math.inf, 0
        suffix = s[i - 2 : i] if i > 1 else s[:1]
        for size in sizes.get(suffix) or vocabulary.sizes_before(suffix):
            if size > i:
                break
            piece = scores.get(s[i - size : i])
            if piece is not None and (x := best[(i - size) % reach] + piece) > top:
                top, n = x, count[(i - size) % reach] + 1
        if s[i - 1] not in scores and (x := best[(i - 1) % reach] + unknown) > top:
            top, n = x, count[(i - 1) % reach] + len(s[i - 1].encode("utf-8", "replace"))
        best[i % reach], count[i % reach] = top, n
    return count[len(s) % reach]


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Replace ``text`` by its numbers of words and tokens."""
    vocabulary = load_vocabulary(path or default_path())
    known: dict[str, int] = {}
    held = 0  # characters of what is known

    def count(texts: list[str]) -> dict[str, list]:
        nonlocal held
        split = [t.split() for t in texts]
        new = {w for ws in split for w in ws if w not in known}
        if len(known) + len(new) > KEPT or held > KEPT_CHARS:
            known.clear()
            held = 0
            new = {w for ws in split for w in ws}
        held += sum(map(len, new))
        known.update(count_sorted(sorted(w for w in new if len(w) <= LONG), vocabulary))
        known.update((w, count_long(w, vocabulary)) for w in new if len(w) > LONG)
        return {"n_words": [len(ws) for ws in split], "n_tokens": [sum(map(known.__getitem__, ws)) for ws in split]}

    return map_texts(docs, count, "n_words long, n_tokens long", text)


def op9_count_tokens(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
