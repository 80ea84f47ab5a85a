"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_kept, join_small, small_batches, stored

#: Labelled documents, and code points of them together, that the model is fitted on at most. Both bounds are dealt
#: equally to the languages, but no language gets fewer than LEAST_DOCS documents if it has them and they are short enough.
TRAIN_DOCS, TRAIN_CHARS, LEAST_DOCS = 1500, 1_500_000, 20
#: Hashed features; words of one stretch of a chain; words after which a task forgets those it remembers; scores (words x
#: labels) that fitting holds at once; words whose features are named together (their numbers have 10 bits).
FEATURES, CHAIN, REMEMBERED, FIT_SCORES, NAMED = 1 << 15, 256, 150_000, 1 << 22, 1 << 10
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The words of a text in lower case: runs of letters (category L).

    To `re` numbers such as \u00b2 \u00bd \u2167 are word characters too; words that have some, which are rare, are cut at them."""
    found = WORD.findall(text.lower())
    if "".join(found).isalpha():
        return found
    return [part for w in found for part in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def crc_table() -> np.ndarray:
    """What a byte does to a CRC-32 state."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ 0xEDB88320, table >> 1).astype(np.uint32)
    return table


CRC = crc_table()


def longer(state: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """CRC-32 states after the UTF-8 bytes of one more letter each."""
    out, most = state.copy(), int(letters.max(initial=0))
    for shift, least, beyond, lead in ((18, 0x10000, 0x110000, 0xF0), (12, 0x800, 0x10000, 0xE0), (6, 0x80, 0x800, 0xC0), (0, 0, 0x80, 0)):
        if most < least:
            continue
        at = np.flatnonzero(letters >= least) if least else slice(None)
        c = letters[at]
        byte = np.where(c < beyond, lead | c >> shift, 0x80 | c >> shift & 0x3F) if most >= beyond else lead | c >> shift
        out[at] = CRC[(out[at] ^ byte) & 0xFF] ^ out[at] >> 8
    return out


def features_of(words: list[str], lexicon: frozenset[str] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words in lower case, one word's after the other's, and how many each word has.

    A word's names are p and its first 1 to 4 letters, s and its last 1 to 4, the n-grams of 2, then of 3, of the word
    between < and >, and w and the word if the lexicon has it, each once, at its first place; a name's feature is its CRC-32
    modulo FEATURES. All words' names are hashed together, a letter at a time; NAMED words at once."""
    made = [features_of_few(words[k : k + NAMED], lexicon) for k in range(0, len(words), NAMED)]
    return np.concatenate([np.zeros(0, np.int64), *(m[0] for m in made)]), np.concatenate([np.zeros(0, np.int64), *(m[1] for m in made)])


def features_of_few(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """features_of() for 1 to NAMED words: every name has a slot, those that repeat an earlier one of the word go at the end."""
    letters = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), np.uint32)
    n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 2)
    first = ends - size - 2  # of <
    slots = 2 * size + 10  # four p, four s, n-grams of 2 and of 3, w
    base = np.cumsum(slots) - slots
    total = int(slots.sum())
    state, used = np.zeros(total, np.uint32), np.zeros(total, bool)
    key = np.zeros(total, np.uint64)  # word and name, for names of two or three letters, as letters (category L) lie below 2 ** 18
    word = np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(54), slots)

    def named(*name: np.ndarray | int) -> np.ndarray:
        out = np.zeros(1, np.uint64)
        for c in (*name, 0)[:3]:
            out = out << np.uint64(18) | np.asarray(c).astype(np.uint64)
        return out

    start = np.full(n, 0xFFFFFFFF, np.uint32)
    for head, slot in (("p", 0), ("s", 4)):
        opened = longer(start, np.full(n, ord(head), np.uint32))
        for k in range(1, 5):
            has = np.flatnonzero(size >= k)
            at = first[has] + 1 if head == "p" else ends[has] - 1 - k
            now = opened[has]
            for x in range(k):
                now = longer(now, letters[at + x])
            to = base[has] + slot + k - 1
            state[to], used[to] = now, True
            if k < 3:
                key[to] = named(ord(head), *(letters[at + x] for x in range(k)))
    owner = np.repeat(np.arange(n), size + 2)
    to = np.arange(len(letters)) + (base + 8 - first)[owner]  # of the n-gram of 2 that begins at a letter
    two = np.flatnonzero(np.arange(len(letters)) + 1 < ends[owner])
    three = np.flatnonzero(np.arange(len(letters)) + 2 < ends[owner])
    state_two = np.zeros(len(letters), np.uint32)
    state_two[two] = longer(longer(np.full(len(two), 0xFFFFFFFF, np.uint32), letters[two]), letters[two + 1])
    state[to[two]], key[to[two]] = state_two[two], named(letters[two], letters[two + 1])
    on = to[three] + size[owner[three]] + 1
    state[on], key[on] = longer(state_two[three], letters[three + 2]), named(letters[three], letters[three + 1], letters[three + 2])
    used[to[two]] = used[on] = True
    for i, w in enumerate(words):
        if w in lexicon:
            state[base[i] + slots[i] - 1], used[base[i] + slots[i] - 1] = zlib.crc32(f"w{w}".encode()) ^ 0xFFFFFFFF, True
    short = np.flatnonzero(key)
    names = key[short] | word[short]
    order = np.argsort(names)
    names = names[order]
    runs = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    used[short] = False
    used[short[np.minimum.reduceat(order, runs)]] = True
    return ((state[used] ^ 0xFFFFFFFF) % FEATURES).astype(np.int64), np.add.reduceat(used, base, dtype=np.int64)


class Crf:
    """Scores of labels for words (sums of feature weights) and of label transitions."""

    def __init__(self, labels: list[str], lexicon: frozenset[str] = frozenset()):
        self.labels, self.lexicon = labels, lexicon
        self.weights = np.zeros((FEATURES + 1, len(labels)))  # the last row pads
        self.transitions = np.zeros((len(labels), len(labels)))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores (words x labels); the mean over a word's features keeps long words from weighing more."""
        if not words:
            return np.zeros((0, len(self.labels)))
        flat, sizes = features_of(words, self.lexicon)
        return np.add.reduceat(self.weights[flat], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0) / np.sqrt(sizes)[:, None]

    def moves(self) -> np.ndarray:
        return np.exp(self.transitions - self.transitions.max())

    def forward_backward(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals of labels, summed marginals of transitions, log likelihood of all chains' normalisers."""
        n, steps, k = scores.shape
        move = self.moves()
        top = scores.max(2, keepdims=True)
        seen = np.exp(scores - top)
        live = np.arange(steps)[None, :] < lengths[:, None]
        ahead = np.empty_like(seen)
        scale = np.ones((n, steps))
        a = seen[:, 0]
        for t in range(steps):
            if t:
                a = (ahead[:, t - 1] @ move) * seen[:, t]
            scale[:, t] = np.where(live[:, t], a.sum(1), 1.0)
            ahead[:, t] = np.where(live[:, t, None], a / scale[:, t, None], ahead[:, t - 1] if t else a)
        last = np.ones((n, k))
        back = last
        out = np.empty_like(seen)
        pairs = np.zeros((k, k))
        out[:, -1] = ahead[:, -1] * back
        for t in range(steps - 2, -1, -1):
            inner = live[:, t + 1]
            moved = seen[:, t + 1] * back / scale[:, t + 1, None]
            pairs += np.einsum("ni,nj->ij", ahead[inner, t], moved[inner]) * move
            back = np.where(inner[:, None], moved @ move.T, last)
            out[:, t] = ahead[:, t] * back
        return out, pairs, float((np.log(scale) * live).sum() + (top[:, :, 0] * live).sum() + self.transitions.max() * (lengths - 1).sum())

    def marginals(self, seen: np.ndarray, going: list[int], before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Marginals of labels (steps x labels x chains) of stretches of chains, longest first, from their words' weights.

        going: how many stretches have a step; before and after (labels x chains): messages from what a stretch goes on
        from and what goes on after it."""
        move, ahead = self.moves(), np.zeros_like(seen)
        scale = np.ones((len(seen), seen.shape[2]))
        a = seen[0] * before
        for t, n in enumerate(going):
            if t:
                a = (move.T @ ahead[t - 1, :, :n]) * seen[t, :, :n]
            a.sum(0, out=scale[t, :n])
            np.divide(a, scale[t, :n], out=ahead[t, :, :n])
        back = after.copy()
        ahead[-1] *= back
        for t in range(len(seen) - 2, -1, -1):
            n = going[t + 1]
            back[:, :n] = move @ (seen[t + 1, :, :n] * back[:, :n] / scale[t + 1, :n])
            ahead[t] *= back
        ahead /= np.maximum(ahead.sum(1, keepdims=True), np.finfo(float).tiny)
        return ahead

    def transfers(self, seen: np.ndarray, going: list[int]) -> np.ndarray:
        """What each stretch does to messages (labels x labels x stretches, up to a factor): the product of its words'
        weights and the transitions between them. Arguments as in marginals()."""
        move = self.moves()
        out = np.eye(seen.shape[1])[:, :, None] * seen[0]
        for t, n in enumerate(going):
            if t:
                now = (move.T @ out[:, :, :n]) * seen[t, :, :n]
                out[:, :, :n] = now if t % 16 else now / now.sum((0, 1))
        return out


def fit_crf(samples: list[tuple[str, list[str]]], rounds: int = 60, chain: int = 48, seed: int = 7) -> Crf:
    """Maximum likelihood with a Gaussian prior, by Adam, from (language, words) samples.

    Samples are cut into short runs and runs of different languages are laid one after another, so that transitions
    between languages are learned too. The lexicon holds words seen at least five times."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in samples})
    counts: dict[str, int] = {}
    for _, words in samples:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    model = Crf(labels, frozenset(w for w, n in counts.items() if n >= 5))
    vocabulary = {w: i for i, w in enumerate(counts)}
    flat, sizes = features_of([*vocabulary], model.lexicon)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    damp = 1 / np.sqrt(sizes)
    runs = []
    for lang, words in samples:
        at = 0
        while at < len(words):
            step = int(rng.integers(6, 25))
            runs.append((labels.index(lang), [vocabulary[w] for w in words[at : at + step]]))
            at += step
    rng.shuffle(runs)
    word = np.concatenate([np.array(r[1]) for r in runs])
    gold = np.concatenate([np.full(len(r[1]), r[0]) for r in runs])
    n = -(-len(word) // chain)
    lengths = np.full(n, chain)
    lengths[-1] = len(word) - chain * (n - 1)
    pad = n * chain - len(word)
    word = np.concatenate([word, np.zeros(pad, np.int64)]).reshape(n, chain)
    gold = np.concatenate([gold, np.zeros(pad, np.int64)]).reshape(n, chain)
    live = np.arange(chain)[None, :] < lengths[:, None]
    k = len(labels)
    both = live[:, 1:]
    true_moves = np.bincount(gold[:, :-1][both] * k + gold[:, 1:][both], minlength=k * k).reshape(k, k)
    truth = np.eye(k)
    at_once = max(1, FIT_SCORES // (chain * k))
    moments = [np.zeros_like(x) for x in (model.weights, model.weights, model.transitions, model.transitions)]
    total = len(flat)
    for r in range(1, rounds + 1):
        scores = np.add.reduceat(model.weights[flat], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0) * damp[:, None]
        each, moves = np.zeros((len(sizes), k)), np.zeros((k, k))
        for at in range(0, n, at_once):
            part = slice(at, at + at_once)
            marginal, moved, _ = model.forward_backward(scores[word[part]], lengths[part])
            off = ((truth[gold[part]] - marginal) * live[part, :, None]).reshape(-1, k)
            each += np.stack([np.bincount(word[part].ravel(), off[:, j], minlength=len(sizes)) for j in range(k)], 1)
            moves += moved
        each *= damp[:, None]
        grown = np.stack([np.bincount(flat, each[owner, j], minlength=FEATURES + 1) for j in range(k)], 1)
        for param, grad, m, v in ((model.weights, grown - 0.02 * model.weights, *moments[:2]), (model.transitions, true_moves - moves - 0.02 * model.transitions, *moments[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param += 0.15 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
        model.weights[-1] = 0
    assert total == len(flat)
    return model


def tag_batch(model: Crf, texts: list[str | None], known: dict[str, int], table: list[np.ndarray], chain: int = CHAIN) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the text, its words' marginals) for texts with letters, each text one chain.

    Chains are taken in stretches of `chain` words at once, and the messages are carried over the places where they
    meet: first what each stretch of a longer text does to a message, then the messages, then the marginals."""
    words = [words_of(t or "") for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
        table.clear()
    had, put, size = len(known), known.setdefault, known.__len__
    numbers = [np.array([put(w, size()) for w in ws], np.int64) for ws in words]
    new = [*islice(known, had, None)]
    made = [model.emissions(new[k : k + 4096]).astype(np.float32) for k in range(0, len(new), 4096)]
    table[:] = [np.concatenate([*table, *made])] if new else table
    owner, rows = [], []
    for i, row in enumerate(numbers):
        for at in range(0, len(row), chain):
            owner.append(i)
            rows.append(row[at : at + chain])
    k = len(model.labels)
    before, after = np.ones((k, len(rows))), np.ones((k, len(rows)))

    def grids(which: list[int]) -> Iterator[tuple[list[int], np.ndarray, list[int]]]:
        """Stretches, longest first, their words' weights (steps x labels x stretches), and how many have each step."""
        order = sorted(which, key=lambda j: -len(rows[j]))
        for at in range(0, len(order), 512):
            part = order[at : at + 512]
            lengths = np.array([len(rows[j]) for j in part])
            grid = np.zeros((len(part), int(lengths[0])), np.int64)
            for x, j in enumerate(part):
                grid[x, : len(rows[j])] = rows[j]
            scores = np.ascontiguousarray(table[0][grid.T].transpose(0, 2, 1), np.float64)
            yield part, np.exp(scores - scores.max(1, keepdims=True)), np.searchsorted(-lengths, -np.arange(grid.shape[1])).tolist()

    several = [j for j in range(len(rows)) if j and owner[j - 1] == owner[j] or j + 1 < len(rows) and owner[j + 1] == owner[j]]
    if several:
        does: dict[int, np.ndarray] = {}
        for part, seen, going in grids(several):
            does.update(zip(part, model.transfers(seen, going).transpose(2, 0, 1), strict=True))
        move = model.moves()
        for j in several:
            if j + 1 in does and owner[j + 1] == owner[j]:
                m = (before[:, j] @ does[j]) @ move
                before[:, j + 1] = m / m.sum()
        for j in reversed(several):
            if j - 1 in does and owner[j - 1] == owner[j]:
                m = move @ (does[j] @ after[:, j])
                after[:, j - 1] = m / m.sum()
    done: list[np.ndarray | None] = [None] * len(rows)
    for part, seen, going in grids(list(range(len(rows)))):
        got = np.ascontiguousarray(model.marginals(seen, going, before[:, part], after[:, part]).transpose(2, 0, 1))
        for x, j in enumerate(part):
            done[j] = got[x, : len(rows[j])]
    at = 0
    while at < len(owner):
        end = at
        while end < len(owner) and owner[end] == owner[at]:
            end += 1
        yield owner[at], np.concatenate(done[at:end])
        at = end


def training_sample(docs: DataFrame, held_out, text_col: str, lang_col: str, most: int, chars: int) -> list[tuple[str, list[str]]]:
    """Distinct labelled texts with letters outside held_out: `most` of them and `chars` code points at most, each whole.

    Every language gives the texts with its smallest hashes, as far as its share of both bounds goes; texts that are
    longer than its share of code points are passed over, but if it has no other, its shortest text is taken. Numbering
    is done within a cut of hashes that holds few more than wanted, told by the language's number of texts. A text with
    several labels counts for the smallest."""
    rows = docs.where(~held_out & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    known = stored(rows.groupBy("h").agg(F.min("lang").alias("lang"), F.max(F.length("text")).alias("size")), "labelled")  # hashes only
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("size").alias("least"))
    languages = max(1, counts.count())
    share, quota = max(LEAST_DOCS, most // languages), chars // languages
    fits = (F.col("size") <= quota) | (F.col("least") > quota) & (F.col("size") == F.col("least"))
    cut = join_small(known, counts, "lang", "inner", languages, 64).where(fits)  # else all hashes of a language would meet in one task
    near = F.pmod("h", F.lit(1 << 30)) < (4.0 * share + 64) * (1 << 30) / F.col("n")
    order = Window.partitionBy("lang").orderBy("h")
    near = near | (F.col("least") > quota)  # hardly any rows: those of the least length
    chosen = cut.where(near).withColumns({"k": F.row_number().over(order), "all": F.sum("size").over(order)})
    chosen = stored(chosen.where((F.col("k") == 1) | (F.col("k") <= share) & (F.col("all") <= quota)).select("h", "lang"), "chosen")
    taken = join_small(rows, chosen, ["h", "lang"], "left_semi", chosen.count()).dropDuplicates(["h"])
    return [(r["lang"], words_of(r["text"])) for r in taken.orderBy("h").collect()]


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, switches) for every row of docs.

    Held out are the rows whose crc32 of doc_id as text leaves 2 modulo 4; a null doc_id counts as held out. The
    model sees only texts and languages of other rows (a bounded sample, see training_sample()) and predicts from the
    text alone. lang_pred has the largest sum of word marginals over the whole text, score is their mean for it;
    switches counts places where the likeliest label of neighbouring words changes; of equally likely languages the
    first in alphabetical order counts. A text is one chain, however long. Null texts, texts without letters and tables
    without any labelled row give `und` and 0. Repeated ids keep their rows; nothing is shuffled."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))
    sample = training_sample(docs, held, text_col, lang_col, train_docs, train_chars)
    model = fit_crf(sample) if sample else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        known: dict[str, int] = {}
        table: list[np.ndarray] = []
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                pred, score, n, switches = ["und"] * b.num_rows, [0.0] * b.num_rows, [0] * b.num_rows, [0] * b.num_rows
                if model:
                    for i, marginal in tag_batch(model, b.column(2).to_pylist(), known, table):
                        mean = marginal.mean(0)
                        best = int(mean.argmax())
                        likely = marginal.argmax(1)
                        pred[i], score[i], n[i], switches[i] = model.labels[best], float(min(1.0, max(0.0, mean[best]))), len(marginal), int((likely[1:] != likely[:-1]).sum())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(switches, pa.int64())], ["doc_id", "held_out", "lang_pred", "score", "n_words", "switches"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, n_words long, switches long")
