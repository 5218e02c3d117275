"""Token counts under a unigram model, by forward scores on a trie of distinct pre-tokens."""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from obsmill.llm.shared import pieces

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters, and so nodes, of the words of one trie, and the longest pre-token put in it.
MOST_NODES = 400_000
LONGEST_SHARED = 48


def vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Piece to unigram score from a public vocabulary file; bounded by that file.

    The file ranks its pieces. By Zipf's law the piece of rank r scores -log(r + 1); control and
    byte pieces are left out, a character without a piece falls back on its bytes (`Trie`).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(k)
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))
    ]
    return {piece: -math.log(rank + 2) for rank, piece in enumerate(plain)}


class Pieces:
    """An automaton of all pieces: its state after a prefix tells which pieces end there.

    `ends[state, n]` is the score of the piece of n characters that ends there, not a number if there is none.
    """

    def __init__(self, pieces: dict[str, float]):
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.longest = max(map(len, pieces), default=1)
        edges: dict[int, int] = {}
        depth, above, over, own = [0], [0], [0], {}
        for piece, score in pieces.items():
            state = 0
            for char in piece:
                key = state << 21 | ord(char)
                after = edges.get(key)
                if after is None:
                    after = edges[key] = len(depth)
                    depth.append(depth[state] + 1)
                    above.append(state)
                    over.append(ord(char))
                state = after
            if state:
                own[state] = (len(piece), score)
        self.ends = np.full((len(depth), self.longest + 1), np.nan)
        self.fail = np.zeros(len(depth), np.int64)
        for state in sorted(range(1, len(depth)), key=depth.__getitem__):
            back = int(self.fail[above[state]])
            while above[state]:
                found = edges.get(back << 21 | over[state])
                if found is not None or not back:
                    self.fail[state] = found or 0
                    break
                back = int(self.fail[back])
            self.ends[state] = self.ends[self.fail[state]]
            if state in own:
                length, score = own[state]
                self.ends[state, length] = score
        self.keys = np.array(sorted(edges), np.int64)
        self.targets = np.array([edges[k] for k in self.keys.tolist()], np.int64)

    def after(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after one more character each."""
        out = np.zeros(len(states), np.int64)
        if not len(self.keys):
            return out
        left = np.arange(len(states))
        while len(left):
            keys = states << 21 | codes[left]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = self.keys[at] == keys
            out[left[found]] = self.targets[at[found]]
            on = ~found & (states != 0)
            left, states = left[on], self.fail[states[on]]
        return out


def _bytes(codes: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of code points."""
    return 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)


class Trie:
    """Token counts of pre-tokens, by forward scores on a trie of the distinct ones.

    A node is a prefix. It has the best score of a segmentation of its prefix and the number of its tokens;
    both depend on the prefix only, so all words below share them. The trie grows level by level, each node is
    scored once, from its ancestors and the pieces that end there, and a word's count stands at its last node.

    The best segmentation has the greatest sum of piece scores; of equal ones the one with fewer
    tokens. A character without a piece becomes one token a byte, each scored below every piece.
    Words of over `most_nodes` characters in sum are taken in parts, in order, which changes no count.
    """

    def __init__(self, pieces: dict[str, float] | Pieces, most_nodes: int = MOST_NODES):
        self.pieces = pieces if isinstance(pieces, Pieces) else Pieces(pieces)
        self.most_nodes = most_nodes

    def count(self, word: str) -> int:
        return self.counts([word])[0]

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each word, in the order given."""
        order = sorted(range(len(words)), key=words.__getitem__)
        out = [0] * len(words)
        for part in pieces([words[k] for k in order], self.most_nodes):
            own = [order[k] for k in part]
            for k, n in zip(own, self._counted([words[k] for k in own])):
                out[k] = n
        return out

    def _counted(self, words: list[str]) -> list[int]:
        """Tokens of sorted words."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        offsets = np.cumsum(lengths) - lengths
        counts = np.zeros(len(words), np.int64)
        long = np.flatnonzero(lengths > LONGEST_SHARED)
        for k in long.tolist():
            counts[k] = self._alone(codes[offsets[k] : offsets[k] + lengths[k]])
        # `path[d]` is the node of each word at depth d; nodes of all levels are numbered in one row.
        live = np.flatnonzero((lengths > 0) & (lengths <= LONGEST_SHARED))
        path = [np.zeros(len(words), np.int64)]
        score, tokens, states = np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64)
        depth = 0
        while len(live):
            depth += 1
            parents = path[-1][live]
            own = codes[offsets[live] + depth - 1]
            # Words are sorted, so those below one node stand together.
            new = np.ones(len(live), bool)
            new[1:] = (parents[1:] != parents[:-1]) | (own[1:] != own[:-1])
            first, node = np.flatnonzero(new), np.cumsum(new) - 1
            base, word = len(score), live[first]
            here = np.zeros(len(words), np.int64)
            here[live] = base + node
            path.append(here)
            state = self.pieces.after(states[parents[first]], own[first])
            ends = self.pieces.ends[state]
            n = _bytes(own[first])
            up = path[depth - 1][word]
            single = ~np.isnan(ends[:, 1])
            best = np.where(single, -np.inf, score[up] + n * self.pieces.unknown)
            fewest = np.where(single, 0, tokens[up] + n)
            there = ~np.isnan(ends)
            for length in range(1, min(depth, self.pieces.longest) + 1):
                hit = np.flatnonzero(there[:, length])
                if not len(hit):
                    continue
                back = path[depth - length][word[hit]]
                total, number = score[back] + ends[hit, length], tokens[back] + 1
                better = (total > best[hit]) | ((total == best[hit]) & (number < fewest[hit]))
                best[hit[better]], fewest[hit[better]] = total[better], number[better]
            score, tokens, states = (np.concatenate(x) for x in ((score, best), (tokens, fewest), (states, state)))
            done = lengths[live] == depth
            counts[live[done]] = tokens[here[live[done]]]
            live = live[~done]
        return counts.tolist()

    def _alone(self, codes: np.ndarray) -> int:
        """Tokens of a long word: its forward scores share nothing, and only the latest are kept."""
        size = self.pieces.longest + 1
        score, tokens = [0.0] * size, [0] * size
        state = np.zeros(1, np.int64)
        for end in range(1, len(codes) + 1):
            code = codes[end - 1 : end]
            state = self.pieces.after(state, code)
            ends = self.pieces.ends[int(state[0])]
            up = (end - 1) % size
            best, fewest = -math.inf, 0
            if math.isnan(ends[1]):
                n = int(_bytes(code)[0])
                best, fewest = score[up] + n * self.pieces.unknown, tokens[up] + n
            for length in np.flatnonzero(~np.isnan(ends)).tolist():
                back = (end - length) % size
                total = score[back] + float(ends[length])
                if total > best or total == best and tokens[back] + 1 < fewest:
                    best, fewest = total, tokens[back] + 1
            score[end % size], tokens[end % size] = best, fewest
        return tokens[len(codes) % size]


def token_counts(
    documents: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    pieces: dict[str, float] | None = None,
    most_nodes: int = MOST_NODES,
) -> DataFrame:
    """identifier, n_tokens and n_pretokens of every row.

    A pre-token is a run without white space with the word mark before it. The distinct pre-tokens
    of 256 texts go, in order, into a trie, which computes forward scores once for each
    prefix and keeps the count at each end; texts only add up counts. Which pieces end at a
    prefix is told by an automaton of all pieces, which is made once and broadcast: the vocabulary bounds it. A trie
    holds `most_nodes` prefixes or those of one pre-token; more words are put in several, which changes no count. Nothing is
    shuffled, no document is split, and a lost task costs its own rows only.

    Null texts and texts without a pre-token have 0 tokens; repeated rows are rows; an empty table
    gives none; further columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(Pieces(vocabulary() if pieces is None else pieces))
    rows = documents.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = T.StructType(
        [rows.schema["_id"], T.StructField("n_tokens", T.LongType()), T.StructField("n_pretokens", T.LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value, most_nodes)
        for batch in batches:
            tokens, totals = [], []
            for part in range(0, batch.num_rows, 256):
                words = [Counter((t or "").split()) for t in batch.column(1).slice(part, 256).to_pylist()]
                every = sorted(set().union(*words))
                distinct = dict(zip(every, trie.counts([MARK + w for w in every])))
                tokens += [sum(distinct[w] * n for w, n in own.items()) for own in words]
                totals += [own.total() for own in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()), pa.array(totals, pa.int64())],
                names=["_id", "n_tokens", "n_pretokens"],
            )

    return rows.mapInArrow(count, schema).withColumnRenamed("_id", identifier)
