"""BPE encoding of long texts by tree concatenation, and decoding.

A text of more than ``LEAF_CHARS`` is halved until its pieces are short, wherever the cut falls, and the pieces are encoded by
themselves. They are joined two by two, level by level: a window around the join is encoded anew, and the join holds if a run
of tokens of the window agrees exactly, in id and place, with the left piece and another with the right piece. If a side
doesn't agree, the window grows, at last to both pieces.

Words between plain white space are independent of each other, so each different word is encoded once, in pieces and in
windows alike. Windows begin and end at such breaks, the joins of all texts of a batch are made together, and the place of a
token is counted from the window's end of its piece. Where a piece has no break at all, tokens carry their offsets and windows
begin and end anywhere: a pair of neighbouring tokens of a BPE encoding stays valid whatever surrounds it, so the joined
sequence is the encoding of the joined text. Pieces of texts of more than ``PIECE_CHARS`` are rows of their own, encoded in
parallel by any task, and joined in the same way.

Null text counts as empty; empty text has no tokens. Rows are treated one by one: repeated rows get equal results, a null
doc_id is carried, and columns other than the two named are never read. An empty table gives no rows. The pieces of one long
text meet in one task, as the text did in its row; short texts are never shuffled.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import pandas as pd
from pyspark.sql import DataFrame, functions as F

LEAF_CHARS = 2_048  # longer texts are encoded in halves
PIECE_CHARS = 65_536  # the halves of longer texts go to tasks of their own
WINDOW_CHARS, AGREEING = 64, 4
WORD_CHARS = 256  # longer words are not remembered
KNOWN_WORDS = 300_000  # words of a generation; a task remembers two, some 130 MB
TOGETHER = 200  # new words encoded in one call
PLAIN_WORD = re.compile(r"[!-;=-~\u00C0-\u00FF]+")  # characters that composing and lower-casing leave as many bytes; no "<"

_loaded: dict = {}


def tokenizer_of(path: str):
    """The tokenizer of a file, two generations of encoded words, its tokens by id and their sizes, loaded once per process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        most = max(tokenizer.get_vocab().values(), default=-1)
        tokens = [tokenizer.id_to_token(i) for i in range(most + 1)]
        _loaded[path] = (tokenizer, ({}, {}), tokens, _sizes(tokenizer, tokens))
    return _loaded[path]


def _sizes(tokenizer, tokens: list[str]) -> list[int] | None:
    """The bytes of text that each token stands for; None if the characters of plain words don't keep their number of bytes."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    sizes = [len((token or "").removesuffix(suffix)) for token in tokens]
    for one in filter(PLAIN_WORD.fullmatch, map(chr, range(256))):
        ids = tokenizer.encode(f"{one}{one} {one}", add_special_tokens=False).ids
        if sum(sizes[i] for i in ids) != 3 * len(one.encode()):
            return None
    return sizes


def _learn_plain(tokenizer, sizes: list[int], known: dict, new: list[str]) -> list[str]:
    """Encode plain words, many in one call; each ends with the token that completes its bytes. Returns the words of calls where one doesn't."""
    left = []
    for at in range(0, len(new), TOGETHER):
        group = new[at:at + TOGETHER]
        ids = tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids
        tokens_at = {size: n for n, size in enumerate(accumulate(map(sizes.__getitem__, ids)), 1)}
        ends = [tokens_at.get(size) for size in accumulate(len(word.encode()) for word in group)]
        if None in ends or ends[-1] != len(ids):
            left += group
            continue
        packed, begin = array("I", ids).tobytes(), 0
        for word, end in zip(group, ends):
            known[word] = packed[4 * begin:4 * end]
            begin = end
    return left


def _learn_words(tokenizer, sizes: list[int] | None, known: dict, new: list[str]) -> None:
    """Encode new words. Those of plain characters go together as they are, others with a special token between them, and words with
    such strings alone."""
    if sizes:
        plain = [w for w in new if PLAIN_WORD.fullmatch(w)]
        new = [w for w in new if not PLAIN_WORD.fullmatch(w)] + _learn_plain(tokenizer, sizes, known, plain)
    mark, between = next(((i, f" {t.content} ") for i, t in sorted(tokenizer.get_added_tokens_decoder().items()) if t.special), (None, ""))
    alone = [w for w in new if mark is None or "<" in w]
    joint = [w for w in new if mark is not None and "<" not in w]
    for at in range(0, len(joint), TOGETHER):
        group = joint[at:at + TOGETHER]
        ids = tokenizer.encode_batch_fast([between.join(group)], add_special_tokens=False)[0].ids
        begin = 0
        for word in group:
            end = ids.index(mark, begin) if word is not group[-1] else len(ids)
            known[word] = array("I", ids[begin:end]).tobytes()
            begin = end + 1
    for word, found in zip(alone, tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
        known[word] = array("I", found.ids).tobytes()


def encode_texts(path: str, texts: list[str]) -> list[bytes]:
    """The ids of each text as 32-bit numbers, encoding each different word once."""
    tokenizer, (known, earlier), _, sizes = tokenizer_of(path)
    split = [[w for w in t.replace("\n", " ").split(" ") if w] for t in texts]
    if len(known) > KNOWN_WORDS:  # words that were used since the last time stay known
        earlier.clear()
        earlier.update(known)
        known.clear()
    missing = set(chain.from_iterable(split)).difference(known)
    known.update({w: earlier[w] for w in missing if w in earlier})
    _learn_words(tokenizer, sizes, known, [w for w in missing if w not in earlier])
    packed = [b"".join(map(known.__getitem__, words)) for words in split]
    for word in missing:
        if len(word) > WORD_CHARS:
            del known[word]
    return packed


def decode_ids(path: str, ids: list[int]) -> str:
    """The text of ids, special tokens included; without a decoder that is the tokens joined by spaces."""
    tokenizer, _, tokens, _ = tokenizer_of(path)
    return " ".join([tokens[i] for i in ids]) if tokenizer.decoder is None else tokenizer.decode(ids, skip_special_tokens=False)


class Piece:
    """Tokens of a stretch of text: ids with their start and end, counted in the whole text."""

    def __init__(self, start: int, text: str, tokens: list[tuple[int, int, int]]) -> None:
        self.start, self.text, self.tokens = start, text, tokens

    @property
    def end(self) -> int:
        return self.start + len(self.text)


def encode_piece(path: str, start: int, text: str) -> Piece:
    found = tokenizer_of(path)[0].encode(text, add_special_tokens=False)
    return Piece(start, text, [(i, start + a, start + b) for i, (a, b) in zip(found.ids, found.offsets)])


def _first_run(window: list, others: dict, from_left: bool) -> tuple[int, int] | None:
    """Where AGREEING tokens in a row of the window equal tokens in a row of the other side: (in window, in other)."""
    order = range(len(window) - AGREEING + 1) if from_left else range(len(window) - AGREEING, -1, -1)
    for w in order:
        at = others["place"].get(window[w])
        if at is not None and others["tokens"][at:at + AGREEING] == window[w:w + AGREEING]:
            return w, at
    return None


def join_pieces(path: str, left: Piece, right: Piece) -> Piece:
    """The encoding of both texts together."""
    if not left.text or not right.text:
        return Piece(left.start, left.text + right.text, left.tokens + right.tokens)
    cut, reach = left.end, WINDOW_CHARS
    while True:
        low, high = max(left.start, cut - reach), min(right.end, cut + reach)
        window = encode_piece(path, low, left.text[low - left.start:] + right.text[:high - cut]).tokens
        before = [] if low == left.start else [t for t in left.tokens if t[1] >= low]
        after = [] if high == right.end else [t for t in right.tokens if t[2] <= high]
        skip = len(left.tokens) - len(before)
        ends = {"tokens": before, "place": {t: i for i, t in enumerate(before)}}
        begins = {"tokens": after, "place": {t: i for i, t in enumerate(after)}}
        a = (0, 0) if low == left.start else _first_run(window, ends, True)
        b = (len(window), 0) if high == right.end else _first_run(window, begins, False)
        if a and b and a[0] + AGREEING * (low > left.start) <= b[0]:
            head = [] if low == left.start else left.tokens[:skip + a[1]]
            tail = [] if high == right.end else right.tokens[b[1]:]
            return Piece(left.start, left.text + right.text, head + window[a[0]:b[0]] + tail)
        reach *= 2


def join_all(path: str, pieces: list[Piece]) -> list[int]:
    """Joins neighbours level by level."""
    while len(pieces) > 1:
        pieces = [join_pieces(path, *pieces[i:i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return [i for i, _, _ in pieces[0].tokens] if pieces else []


def halves(text: str, most: int = PIECE_CHARS, start: int = 0) -> list[tuple[int, str]]:
    """(start, text) of the pieces of a text, each at most ``most`` code points."""
    if len(text) <= most:
        return [(start, text)]
    middle = len(text) // 2
    return halves(text[:middle], most, start) + halves(text[middle:], most, start + middle)


def summary(path: str, packed: bytes) -> tuple[int, str, str]:
    """Number of tokens, digest of the ids, digest of the decoded text."""
    ids = array("I", packed)
    if sys.byteorder == "big":
        ids.byteswap()
        packed = ids.tobytes()
        ids.byteswap()
    decoded = decode_ids(path, ids.tolist())
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def _window(left: str, right: str, reach: int) -> tuple[int, int]:
    """Where a window of whole words begins in the left text and ends in the right one, ``reach`` or more from the join."""
    far = max(0, len(left) - reach)
    low = max(left.rfind(" ", 0, far), left.rfind("\n", 0, far)) + 1
    return low, min((at for at in (right.find(" ", reach), right.find("\n", reach)) if at >= 0), default=len(right))


def join_texts(path: str, pairs: list[tuple[tuple[str, bytes], tuple[str, bytes]]]) -> list[tuple[str, bytes]]:
    """Text and ids of each pair of neighbours with their ids, joined at windows of whole words."""
    joined: list = [None] * len(pairs)
    apart, reach, run = list(range(len(pairs))), WINDOW_CHARS, 4 * AGREEING
    while apart:
        reaches = [_window(pairs[i][0][0], pairs[i][1][0], reach) for i in apart]
        stretches = []
        for i, (low, high) in zip(apart, reaches):
            tail, head = pairs[i][0][0][low:], pairs[i][1][0][:high]
            stretches += [tail, tail + head, head]
        ids = encode_texts(path, stretches)
        still = []
        for at, (i, (low, high)) in enumerate(zip(apart, reaches)):
            (left, left_ids), (right, right_ids) = pairs[i]
            before, window, after = ids[3 * at:3 * at + 3]
            begins, ends = low > 0, high < len(right)
            holds = (len(window) >= run * (begins + ends)
                     and (not begins or len(before) >= run and left_ids.endswith(before) and window[:run] == before[:run])
                     and (not ends or len(after) >= run and right_ids.startswith(after) and window[-run:] == after[-run:]))
            if holds:
                joined[i] = (left + right, (left_ids[:len(left_ids) - len(before)] if begins else b"") + window
                             + (right_ids[len(after):] if ends else b""))
            else:
                still.append(i)
        apart, reach = still, 2 * reach
    return joined


def encode_halves(path: str, texts: list[str], most: int = LEAF_CHARS) -> list[bytes]:
    """The ids of each text as 32-bit numbers; texts of more than ``most`` code points are encoded in halves and joined."""
    cut = [[leaf for _, leaf in halves(text, most)] for text in texts]
    unsplit = {n for n, leaves in enumerate(cut) if len(leaves) > 1 and not all(" " in leaf or "\n" in leaf for leaf in leaves)}
    encoded = iter(encode_texts(path, [leaf for n, leaves in enumerate(cut) if n not in unsplit for leaf in leaves]))
    nodes = [[] if n in unsplit else [(leaf, next(encoded)) for leaf in leaves] for n, leaves in enumerate(cut)]
    while any(len(row) > 1 for row in nodes):
        pairs = [(row[i], row[i + 1]) for row in nodes for i in range(0, len(row) - 1, 2)]
        joined = iter(join_texts(path, pairs))
        nodes = [[next(joined) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)] for row in nodes]
    return [row[0][1] if row else array("I", join_all(path, [encode_piece(path, *piece) for piece in halves(text, most)])).tobytes()
            for row, text in zip(nodes, texts)]


RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digest(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Key, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every document."""
    key_type = docs.schema[key].dataType.simpleString()
    columns = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
    # the key as text and back: a column of numbers with nulls would reach pandas as floating point
    rows = docs.select(F.col(key).cast("string"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                found = encode_halves(path, part.text.tolist())
                yield pd.DataFrame([(k, *summary(path, packed)) for k, packed in zip(part[key], found)], columns=columns)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, document, value in zip(batch[key], batch.document, batch.text):
                found = halves(value, piece_chars)
                yield pd.DataFrame({key: [k] * len(found), "document": document, "start": [s for s, _ in found], "text": [t for _, t in found]})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, document, start, value in zip(batch[key], batch.document, batch.start, batch.text):
                piece = encode_piece(path, int(start), value)
                ids, begins, ends = zip(*piece.tokens) if piece.tokens else ((), (), ())
                yield pd.DataFrame({key: [k], "document": document, "start": start, "text": value, "ids": [list(ids)],
                                    "begins": [list(begins)], "ends": [list(ends)]})

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start")
        pieces = [Piece(int(s), t, list(zip(map(int, i), map(int, b), map(int, e))))
                  for s, t, i, b, e in zip(group.start, group.text, group.ids, group.begins, group.ends)]
        return pd.DataFrame([(group[key].iloc[0], *summary(path, array("I", join_all(path, pieces)).tobytes()))], columns=columns)

    short = rows.where(F.length("text") <= piece_chars).mapInPandas(whole, f"`{key}` string, {RESULT}")
    # a document is known by its key and text, so that repeated rows stay rows of their own
    numbered = rows.where(F.length("text") > piece_chars).groupBy(F.col(key), F.col("text")).agg(F.count(F.lit(1)).alias("times"))
    long = numbered.select(F.col(key), F.concat_ws(":", F.coalesce(F.col(key), F.lit("null")), F.sha2("text", 256), "times").alias("document"), "text")
    piece_schema = f"`{key}` string, document string, start int, text string"
    pieces = long.mapInPandas(cut, piece_schema).repartition("document", "start").mapInPandas(
        encode, f"{piece_schema}, ids array<int>, begins array<int>, ends array<int>")
    joined = pieces.groupBy("document").applyInPandas(lambda d: join(d).assign(document=d.document.iloc[0]), f"`{key}` string, {RESULT}, document string")
    times = F.split("document", ":")
    many = joined.withColumn("times", F.element_at(times, -1).cast("int")).select(
        *columns, F.explode(F.sequence(F.lit(1), F.col("times")))).select(*columns)
    return short.unionByName(many).withColumn(key, F.col(key).cast(key_type)).select(*columns)
