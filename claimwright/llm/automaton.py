"""Operator 9: byte pair encoding by a tokenization automaton, decoding by its arc labels.

The automaton reads tokens and accepts just the sequences that merging can end in. It starts as one state
with an arc for every first symbol. Then each merge (u, v) -> w, in order of rank, applies its gadget: the
state that u-arcs lead to is copied without its v-arc, u-arcs are turned to the copy, and every state with
a u-arc gets a w-arc to where v led. All arcs of one label always end in the same state, so a state is
named by the label that enters it; a copy is stored as the one arc that it lacks and the step that took it
(``cut``), not as a row of 49,000 arcs.

Encoding follows the accepted path of a pre-split word back from its end. A place within the word lies on at most
one path to the end, as what follows it has one accepted token sequence. So the longest label that ends there and
has the arc to the label after it is taken first, and where no label has, the one after it is given up for a shorter
one: no place is passed twice. Decoding emits the labels of the arcs, as the library does for a file without a decoder:
joined by spaces.

Rows are independent: no shuffle; a task holds one Arrow batch, the tables and bounded memos. Null and empty
texts give no ids; repeated rows are encoded each; other columns are not read.
"""

from __future__ import annotations

from array import array
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from claimwright.llm.common import PAIR, Memo, map_batches, whole_texts
from claimwright.llm.vocabulary import Vocabulary, vocabulary

_NEVER = 1 << 60
#: Symbols at its end that say how long a label may be.
_TAIL = 4


class Automaton:
    """Tables: ``cut`` (state entered by a, label x) to the step that took the x-arc away; ``left`` and
    ``right`` spines of a label, each element with the step at which it went into the next larger one."""

    def __init__(self, v: Vocabulary):
        self.cut: dict[int, int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        self._spines: dict[int, tuple[list, list]] = {}
        self._parts = parts
        self.live = {i for i in v.ids.values()}
        self._known: dict[int, bool] = {}
        for step, (a, b, c) in enumerate(v.merges):
            # The gadget needs a path u, v to act on; without one the new label gets no arc.
            if c in parts:
                raise ValueError(f"two merges make the symbol {c}; a label has one gadget")
            if a not in self.live or b not in self.live or not self._arc(a, b):
                self.live.discard(c)
                continue
            self.cut[a << PAIR | b] = step
            parts[c] = (a, b, step)
        self._found = {s: i for s, i in v.ids.items() if i in self.live}
        #: By its last symbols, the length of the longest label; of those that end a word, without the word end.
        self.longest: dict[str, int] = {}
        self.longest_last: dict[str, int] = {}
        for s in v.ids:
            self.longest[s[-_TAIL:]] = max(len(s), self.longest.get(s[-_TAIL:], 0))
            if s.endswith(v.word_end):
                core = s[: len(s) - len(v.word_end)]
                self.longest_last[core[-_TAIL:]] = max(len(core), self.longest_last.get(core[-_TAIL:], 0))

    def _spine(self, label: int) -> tuple[list, list]:
        found = self._spines.get(label)
        if found is None:
            found = []
            for side in (0, 1):
                spine, x, until = [], label, _NEVER
                while True:
                    spine.append((x, until))
                    if x not in self._parts:
                        break
                    *pair, until = self._parts[x]
                    x = pair[side]
                found.append(spine)
            self._spines[label] = found = tuple(found)
        return found

    def _arc(self, state: int, label: int) -> bool:
        """Whether the state that ``state``-arcs enter has a ``label``-arc. The state lacks it if a gadget took
        the arc of some left part of the label away before that part had grown into the next larger one."""
        cut = self.cut
        for a, gone in self._spine(state)[1]:
            for x, grown in self._spine(label)[0]:
                step = cut.get(a << PAIR | x)
                # A doubled symbol takes its own arc away in the very step that makes the pair.
                if step is not None and step < gone and step <= grown:
                    return False
        return True

    def arc(self, state: int, label: int) -> bool:
        key = state << PAIR | label
        found = self._known.get(key)
        if found is None:
            if len(self._known) >= 300_000:
                self._known.clear()
            found = self._known[key] = self._arc(state, label)
        return found

    def path(self, spelled: str, word_end: str) -> list[int]:
        """Labels of the accepted path over a word's symbols, found from its end."""
        known, find, longest = self._known, self._found.get, self.longest
        out, ends = [], []
        j = len(spelled)
        # A label of at least ``_TAIL`` symbols has the last ones here as its own.
        i = max(0, j - self.longest_last.get(spelled[-_TAIL:], _TAIL - 1)) if j >= _TAIL else 0
        after = None
        while j:
            while i < j:
                label = find(spelled[i:j]) if out else find(spelled[i:] + word_end)
                if label is not None:
                    if after is None:
                        break
                    there = known.get(label << PAIR | after)
                    if there is None:
                        there = self.arc(label, after)
                    if there:
                        break
                i += 1
            else:
                # No label that ends here has the arc: the one after it is a shorter one.
                out.pop()
                i, j = j + 1, ends.pop()
                after = out[-1] if out else None
                continue
            out.append(label)
            ends.append(j)
            after, j = label, i
            i = 0
            if j >= _TAIL:
                i = j - longest.get(spelled[j - _TAIL : j], _TAIL - 1)
                if i < 0:
                    i = 0
        return out[::-1]


class Codec:
    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.automaton = Automaton(self.v)
        self.labels = [self.v.labels[i] for i in range(max(self.v.labels) + 1)]
        self._word = Memo(self._encode_word)
        self._chunk = Memo(self._both)

    def _both(self, chunk: str) -> tuple[bytes, str | None]:
        """Ids of a chunk and what they decode to; None where there are no ids, which add no space either."""
        words = self.v.words(chunk)
        if len(words) == 1:
            return self._word[words[0]]
        found = list(map(self._word.__getitem__, words))
        return b"".join([ids for ids, _ in found]), " ".join([decoded for _, decoded in found]) if found else None

    def _encode_word(self, word: str) -> tuple[bytes, str]:
        labels = self.automaton.path(self.v.spelled(word), self.v.word_end)
        return array("I", labels).tobytes(), " ".join(map(self.labels.__getitem__, labels))

    def _pairs(self, text: str) -> list[tuple[bytes, str | None]]:
        out = []
        for k, part in enumerate(self.v.parts(text)):
            if k % 2:
                ids = array("I", [self.v.specials[part]]).tobytes()
                out.append((ids, self.decode(ids)))
            elif self.v.latin(part):
                out.extend(map(self._word.__getitem__, self.v.words(part)))
            else:
                out.extend(map(self._chunk.__getitem__, self.v.chunks(part)))
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join([ids for ids, _ in self._pairs(text)])

    def round_trip(self, text: str) -> tuple[bytes, str]:
        """Ids and what they decode to, that is the decoded chunks joined by spaces: labels never join across chunks."""
        pairs = self._pairs(text)
        return b"".join([ids for ids, _ in pairs]), " ".join([decoded for _, decoded in pairs if decoded is not None])

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.labels.__getitem__, array("I", ids)))


@cache
def codec(path: str) -> Codec:
    """Compiled once in each Python worker."""
    return Codec(path)


def encoded(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (little-endian 32-bit) and the decoded text."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        trips = [c.round_trip(t) for t in rows.column("text").to_pylist()]
        ids = [i for i, _ in trips]
        out = [rows.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha256(i).hexdigest() for i in ids])]
        if not keep_ids:
            return pa.RecordBatch.from_arrays([*out, pa.array([sha256(t.encode()).hexdigest() for _, t in trips])], names=names)
        texts = [t for _, t in trips]
        return pa.RecordBatch.from_arrays(
            [*out, pa.array([sha256(t.encode()).hexdigest() for t in texts]), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=names
        )

    kinds = ["bigint", "bigint", "string", "string", "binary", "string"]
    return map_batches(whole_texts(docs), batch, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
