"""Token counts of sections, from one encoding of the whole document.

Each document is encoded whole, with the character span of every token. The spans
are interval-joined to the document's sections by binary search, inside the task that
has the document. A token over a border goes by the rule:

* ``first``: to the section of its first character,
* ``most``: to the section with most of its characters, of equal ones the first,
* ``share``: to all its sections, in proportion to its characters.

Sections are the lines of the text, each with the line break that ends it, so they
cover the text without gaps; the parts of one character that several tokens encode
are all spans of that character.

Defined results: a null or empty text has one empty section without tokens; rows that
repeat an id are counted one by one; a null id is kept; other columns are not read; an
empty table gives no rows.
"""

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillmart.llm.common import Remembered, byte_signs, is_latin, kept, small_batches, text_of

COUNTS = "doc_id long, section int, start long, stop long, n_tokens double, n_crossing long"
RULES = ("first", "most", "share")
#: Bytes of a start and a stop.
PAIR = 8
#: White space other than blanks and line breaks; a text with it is encoded in one go.
ODD_SPACE = re.compile(r"[^\S \n]")
CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


class Spans(Remembered):
    """Starts and stops of the tokens of a chunk: blanks and line breaks, then other characters up to the next.

    The byte-level tokenizer never lets a token go on from other characters into white
    space, so the tokens of a text are those of its chunks in order. Letters with a blank
    before them go straight to the merges; a full stop or comma at their end is a token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.signs = byte_signs()

    def find(self, chunk: str) -> bytes:
        if chunk[-1:] in (".", ",") and chunk[1:-1].isalpha() and chunk[0] == " ":
            return self[chunk[:-1]] + struct.pack("<2i", len(chunk) - 1, len(chunk))
        if chunk[1:].isalpha() and chunk[0] == " " and is_latin(chunk):
            signs = [self.signs[char] for char in chunk]
            # the character of each byte
            of_byte = [place for place, sign in enumerate(signs) for _ in sign]
            spans, start = [], 0
            for token in self.tokenizer.model.tokenize("".join(signs)):
                stop = start + len(token.value)
                spans += of_byte[start], of_byte[stop - 1] + 1
                start = stop
        else:
            spans = [end for span in self.tokenizer.encode(chunk, add_special_tokens=False).offsets for end in span]
        return struct.pack(f"<{len(spans)}i", *spans)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        chunks = [text] if ODD_SPACE.search(text) else CHUNK.findall(text)
        found = list(map(self.__getitem__, chunks))
        begins = np.cumsum([0, *map(len, chunks)])[:-1]
        shift = np.repeat(begins, np.fromiter(map(len, found), np.int64, len(found)) // PAIR)
        spans = np.frombuffer(b"".join(found), np.int32).reshape(-1, 2)
        return spans[:, 0] + shift, spans[:, 1] + shift


def lines_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the lines, each with its line break."""
    ends = [match.end() for match in re.finditer("\n", text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    stops = np.array(ends, np.int64)
    return np.concatenate([[0], stops[:-1]]), stops


def allocate(starts: np.ndarray, stops: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and border tokens that touch each section. Sections are in order, without gaps."""
    counts, crossing = np.zeros(len(begins)), np.zeros(len(begins), np.int64)
    first = np.searchsorted(begins, starts, side="right") - 1
    last = np.searchsorted(begins, np.maximum(stops - 1, starts), side="right") - 1
    inside = first == last
    np.add.at(counts, first[inside], 1)
    for token in np.flatnonzero(~inside):
        own = np.arange(first[token], last[token] + 1)
        chars = np.minimum(ends[own], stops[token]) - np.maximum(begins[own], starts[token])
        crossing[own[chars > 0]] += 1
        if rule == "share":
            counts[own] += chars / chars.sum()
        else:
            counts[own[0 if rule == "first" else chars.argmax()]] += 1
    return counts, crossing


def count_tokens(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", rule: str = "most") -> DataFrame:
    """One row per document and section: its span (code points), its tokens and the border tokens that touch it."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def count_in(text: str, spans: Spans) -> tuple[np.ndarray, ...]:
        begins, ends = lines_of(text)
        return begins, ends, *allocate(*spans.of(text), begins, ends, rule)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spans = kept(f"spans of {tokenizer}", lambda: Spans(tokenizer))
        for frame in frames:
            for at in range(0, len(frame), 1000):
                part = frame.iloc[at : at + 1000]
                found = [count_in(text, spans) for text in part["text"]]
                sections = [len(own[0]) for own in found]
                out = {"doc_id": part["doc_id"].repeat(sections).array, "section": np.concatenate([np.arange(n) for n in sections])}
                for place, name in enumerate(("start", "stop", "n_tokens", "n_crossing")):
                    out[name] = np.concatenate([own[place] for own in found])
                yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInPandas(count, COUNTS)
