"""Problem 1: noise of scanned pages, found line by line and repaired into paragraphs.

Three averaged perceptrons are trained on each run, on the corpus itself and without labels:

* a character editor. The corpus' frequent words, given the misreadings that scanning makes,
  are its training pairs; for each character it predicts keep, delete, or another string
  (replace, or replace and insert). Its proposals for a word count only if they lead to a
  word the corpus knows far better.
* line joins, the editor's operation between lines. Words of the corpus broken anywhere, half of them as if the
  corpus didn't know them, and compounds broken at their own hyphen are its training pairs; it predicts join or keep
  from what the dictionary knows of both parts and of the whole.
* a furniture classifier over lines with features of the position on the page: distance
  to the edges of the document and to the nearest page number, recurrence at page distance,
  and whether the line interrupts a sentence.

Word counts cover all documents. The samples models are fitted on are bounded by parameters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEXICON_WORDS, TRAINING_WORDS, TRAINING_DOCUMENTS = 2_000_000, 3_000, 400
_RATIO, _LEAST = 20, 20  # a repair must be that many times as frequent, and that frequent at all
_HASH = 1 << 14
# What scanning commonly turns a string into.
CONFUSIONS = (
    ("u", "ii"), ("n", "ri"), ("m", "rn"), ("d", "cl"), ("h", "b"), ("e", "c"), ("a", "o"), ("t", "f"), ("i", "l"), ("l", "i"), ("o", "0"), ("s", "5"), ("l", "1"), ("i", "1"),
    ("g", "9"), ("b", "6"), ("c", "e"), ("o", "a"), ("f", "t"), ("b", "h"), ("rn", "m"), ("cl", "d"), ("li", "h"), ("vv", "w"), ("w", "vv"), ("v", "y"), ("y", "v"), ("n", "u"), ("u", "n"), ("r", "n"), ("z", "2"), ("e", "o"), ("o", "e"),
)
_STRAY = "|~'`^*_•·"
KEEP, DELETE = "=", ""
WORDS = re.compile(r"[^\W\d_]+")
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
_TOKEN = re.compile(r"[^\W_](?:[^\W_]|[|~'’`^*•·](?=[^\W_]))*")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_] ){2,}[^\W\d_](?![^\W_])")
_BREAK = re.compile(r"([^\W_]+(?:[-'’|~][^\W_]+)*)[-‐¬\xad]\s*$")
_LINE_END = re.compile(r"[-‐¬\xad]\s*\n\s*")
_LAST_WORD = re.compile(r"[^\W\d_]+\Z")
_NUMBER_LINE = re.compile(r"^\W*(?:(?:page|pg|pág|página|p)\b\W*)?(?:\d{1,4}|[ivxlc]{1,6})(?:\s*(?:of|/|de)\s*\d{1,4})?\W*$", re.I)


class Editor:
    """Averaged perceptron over hashed windows of characters."""

    def __init__(self, ops: list[str], weights: np.ndarray) -> None:
        self.ops, self.weights = ops, weights

    @staticmethod
    def features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashed features of every character, index of the token of every character)."""
        pad = 3
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        codes = np.frombuffer("".join("\0" * pad + t + "\0" * pad for t in tokens).encode("utf-32-le"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(tokens)), lengths + 2 * pad)
        inside = np.concatenate([np.r_[np.zeros(pad, bool), np.ones(n, bool), np.zeros(pad, bool)] for n in lengths]) if len(tokens) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        windows = ((0,), (-1, 0), (0, 1), (-1, 0, 1), (-2, -1, 0), (0, 1, 2), (-2, -1, 0, 1), (-1, 0, 1, 2), (-3, -2, -1, 0), (0, 1, 2, 3), (-2, -1, 0, 1, 2), (-3, -2, -1, 0, 1, 2, 3))
        out = np.empty((len(at), len(windows)), np.int64)
        for k, window in enumerate(windows):
            h = np.full(len(at), k + 1, np.uint64)
            for d in window:
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[at + d]
            h ^= h >> np.uint64(32)
            out[:, k] = (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(_HASH)
        return out, owner[at]

    @classmethod
    def train(cls, words: list[str], rounds: int = 3, seed: int = 7) -> Editor:
        random = np.random.default_rng(seed)
        ops = [KEEP, DELETE, *sorted({a for a, b in CONFUSIONS})]
        index = {o: i for i, o in enumerate(ops)}
        tokens, goals = [], []
        for word in words:
            for _ in range(3):
                token, goal = _noised(word, random, index)
                tokens.append(token)
                goals.append(goal)
        feats, owner = cls.features(tokens)
        gold = np.concatenate(goals)
        weights, total, last = np.zeros((_HASH, len(ops)), np.float32), np.zeros((_HASH, len(ops)), np.float32), 0
        step = 0
        for _ in range(rounds):
            for block in np.array_split(random.permutation(len(gold)), max(1, len(gold) // 64)):
                step += 1
                f, g = feats[block], gold[block]
                guess = weights[f].sum(axis=1).argmax(axis=1)
                wrong = guess != g
                if wrong.any():
                    f, g, guess = f[wrong], g[wrong], guess[wrong]
                    for o, sign in ((g, 1.0), (guess, -1.0)):
                        np.add.at(weights, (f, o[:, None]), sign)
                        np.add.at(total, (f, o[:, None]), sign * step)
        return cls(ops, (weights - total / max(step, 1)).astype(np.float32))

    def proposals(self, tokens: list[str]) -> Iterator[list[str]]:
        """For each token the strings the editor proposes, the likeliest first."""
        if not tokens:
            return
        feats, owner = self.features(tokens)
        start = np.searchsorted(owner, np.arange(len(tokens) + 1))
        for low in range(0, len(tokens), 4000):
            high = min(len(tokens), low + 4000)
            scores = self.weights[feats[start[low] : start[high]]].sum(axis=1)
            gain = scores - scores[:, :1]
            gain[:, 0] = -np.inf
            best = np.argsort(-gain, axis=1)[:, :3]
            for k in range(low, high):
                token, a = tokens[k], start[k] - start[low]
                n = len(token)
                local = [(float(gain[a + i, o]), i, self.ops[o]) for i in range(n) for o in best[a + i]]
                local.sort(key=lambda x: -x[0])
                out = ["".join(self.ops[best[a + i, 0]] if gain[a + i, best[a + i, 0]] > 0 else token[i] for i in range(n))]
                for _, i, op in local[: 2 * n]:
                    out.append(token[:i] + op + token[i + 1 :])
                    if op:
                        out.append(token[:i] + op + token[i + 2 :])  # two characters read for one
                yield out


def _noised(word: str, random: np.random.Generator, index: dict[str, int]) -> tuple[str, np.ndarray]:
    """The word with a misreading, and for each character of it the edit that takes it back."""
    keep = index[KEEP]
    kind = random.random()
    if kind < 0.3:
        return word, np.full(len(word), keep)
    if kind < 0.5:
        at = int(random.integers(1, len(word)))
        return word[:at] + _STRAY[int(random.integers(len(_STRAY)))] + word[at:], np.r_[np.full(at, keep), index[DELETE], np.full(len(word) - at, keep)]
    fits = [(i, a, b) for a, b in CONFUSIONS for i in range(len(word)) if word.startswith(a, i)]
    if not fits:
        return word, np.full(len(word), keep)
    i, a, b = fits[int(random.integers(len(fits)))]
    goal = [index[a]] + [index[DELETE]] * (len(b) - 1)
    return word[:i] + b + word[i + len(a) :], np.r_[np.full(i, keep), goal, np.full(len(word) - i - len(a), keep)].astype(np.int64)


_LINE_FEATURES = 23


def _may_run(words: list[str]) -> bool:
    """Running lines are titles: three words in small letters make a line part of the text."""
    small = 0
    for w in words:
        if w[0].islower():
            small += 1
            if small == 3:
                return False
    return bool(words)


def _line_features(lines: list[str], split: list[list[str]]) -> tuple[list[int], np.ndarray]:
    """The lines that may be furniture, and the form and page position of each."""
    n = len(lines)
    filled = [i for i in range(n) if split[i]]
    place = {i: k for k, i in enumerate(filled)}
    may = [i for i in filled if _may_run(split[i])]
    bare = {i: lines[i].strip() for i in may}
    keys = {i: re.sub(r"\W*\d+\W*|\W+", " ", bare[i]).strip().lower() for i in may}
    times = Counter(k for k in keys.values() if k)
    number = {i: bool(_NUMBER_LINE.match(bare[i])) and not re.search(r"\d,\d|^\d+\.$", bare[i]) for i in may}
    near = np.array([i for i in may if number[i]])
    wide = max(map(len, lines), default=0)
    out = np.zeros((len(may), _LINE_FEATURES), np.float32)
    for row, i in enumerate(may):
        b, k = bare[i], place[i]
        up, down = (lines[filled[k - 1]].rstrip() if k else ""), (lines[filled[k + 1]].lstrip() if k + 1 < len(filled) else "")
        gap = int(np.abs(near - i).min()) if len(near) else 99
        capital = sum(w[0].isupper() for w in split[i]) / len(split[i])
        out[row] = (
            1, number[i], times[keys[i]] > 1 and len(keys[i]) > 8, times[keys[i]] > 2 and len(keys[i]) > 8,
            k == 0, k == 1, k == len(filled) - 1, k == len(filled) - 2,
            gap in (1, 2), gap == 0 and 0 < i < n - 1,
            capital > 0.5 and bool(re.search(r"\b(?:19|20)\d{2}\b", b)), b.isupper(), b[-1] in ".;:,", capital > 0.6,
            bool(up) and up[-1] not in ".:;!?" and down[:1].islower(), bool(re.search(r"(?:^\d{1,3}\s{2,}\D|^\D.*\s{2,}\d{1,3}$|^\d{1,3} [A-Z].*/|\| *\d+$)", b)),
            len(b) < 12, len(b) > 0.9 * wide, i == 0 or not split[i - 1], i + 1 == n or not split[i + 1],
            "\f" in lines[i][:2], k + 1 < len(filled) and "\f" in lines[filled[k + 1]][:2],  # next to a page break
            k == 0 and (down[:1].islower() or down[:1].isdigit()),  # an opening sentence that goes on
        )
    return may, out


def _weak_label(f: np.ndarray) -> np.ndarray:
    """1 furniture, -1 not, 0 unknown: what a line's form alone makes certain."""
    label = np.zeros(len(f), np.int8)
    label[(f[:, 1] > 0) | ((f[:, 2] > 0) & (f[:, 10] > 0)) | ((f[:, 3] > 0) & (f[:, 8] > 0) & (f[:, 13] > 0))] = 1
    label[(f[:, 12] > 0) & (f[:, 2] == 0) & (f[:, 1] == 0) | (f[:, 17] > 0) & (f[:, 13] == 0)] = -1
    heading = (f[:, 18] > 0) & (f[:, 19] > 0) & (f[:, 1] == 0) & (f[:, 10] == 0) & (f[:, 15] == 0)
    plain = (f[:, 1] == 0) & (f[:, 2] == 0) & (f[:, 10] == 0) & (f[:, 15] == 0)  # no number, no date, never again
    label[heading | plain | (f[:, 22] > 0) & (f[:, 2] == 0)] = -1
    return label


def _train_furniture(texts: list[str], rounds: int = 6, seed: int = 7) -> np.ndarray:
    pairs = _LINE_FEATURES * (_LINE_FEATURES - 1) // 2
    weights, total, step = np.zeros(_LINE_FEATURES + pairs), np.zeros(_LINE_FEATURES + pairs), 0
    rows, labels = [], []
    for text in texts:
        lines = text.split("\n")
        f = _line_features(lines, [x.split() for x in lines])[1]
        y = _weak_label(f)
        rows.append(f[y != 0])
        labels.append(y[y != 0])
        # a running line of a short document: dated, capitalised, at the edge, like those that recur in longer ones
        edge = (y == 0) & (f[:, 10] > 0) & ((f[:, 4] > 0) | (f[:, 6] > 0) | (f[:, 8] > 0)) & (f[:, 12] == 0) & ((f[:, 22] == 0) | (f[:, 2] > 0))
        rows.append(f[edge])
        labels.append(np.ones(int(edge.sum()), np.int8))
    if not rows or not sum(map(len, rows)):
        return weights
    x, y = _crossed(np.concatenate(rows)), np.concatenate(labels).astype(np.float64)
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in random.permutation(len(y)):
            step += 1
            if y[i] * (x[i] @ weights) <= 0:
                weights += y[i] * x[i]
                total += step * y[i] * x[i]
    return weights - total / max(step, 1)


def _crossed(f: np.ndarray) -> np.ndarray:
    a, b = np.triu_indices(f.shape[1], 1)
    return np.concatenate([f, f[:, a] * f[:, b]], axis=1)


def _join_features(left: str, right: str, whole: int, lone: tuple[int, int], known: tuple[bool, bool], compound: bool, soft: bool) -> list[float]:
    """What tells a broken word from a compound: counts of the whole, of both parts standing alone, and whether the compound is one the corpus writes."""
    return [
        1, whole >= 3, whole >= _LEAST, whole >= _RATIO * max(min(lone), 1), known[0], known[1], known[0] and known[1], compound,
        compound and whole < _LEAST, soft, len(right) < 4 and not known[1], len(left) < 4 and not known[0],
    ]


def _train_joins(model: Model, words: list[str], rounds: int = 6, seed: int = 7) -> np.ndarray:
    """Weights of the averaged perceptron for line joins."""
    random = np.random.default_rng(seed)
    rows, labels = [], []
    for word in words:
        if len(word) > 5:
            at = int(random.integers(2, len(word) - 1))
            rows.append(model.join_features(word[:at], word[at:], False, hidden=random.random() < 0.5))
            labels.append(1.0)
    for compound in sorted(model.compounds)[: len(words)]:
        left, _, right = compound.rpartition("-")
        rows.append(model.join_features(left.split("-")[-1], right, False, stem=left))
        labels.append(-1.0)
    if not rows:  # nothing to learn from: join
        rows, labels = [[1.0] + [0.0] * (_JOIN_FEATURES - 1)], [1.0]
    x, y = _crossed(np.array(rows, np.float64)), np.array(labels)
    weights, total, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for _ in range(rounds):
        for i in random.permutation(len(y)):
            step += 1
            if y[i] * (x[i] @ weights) <= 0:
                weights += y[i] * x[i]
                total += step * y[i] * x[i]
    return weights - total / max(step, 1)


_JOIN_FEATURES = 12


def _usual(token: str, word: str) -> bool:
    """Whether one stray mark or one usual confusion makes the token of the word."""
    for i in range(len(token)):
        if token[i] in _STRAY and token[:i] + token[i + 1 :] == word:
            return True
    return any(token[:i] + a + token[i + len(b) :] == word for a, b in CONFUSIONS for i in range(len(token)) if token.startswith(b, i))


class Model:
    def __init__(self, counts: dict[str, int], compounds: set[str], editor: Editor, furniture: np.ndarray, pieces: dict[str, int]) -> None:
        self.counts, self.compounds, self.editor, self.furniture, self.pieces = counts, compounds, editor, furniture, pieces
        self.prefixes = {"-".join(c.split("-")[:k]) for c in compounds for k in range(2, c.count("-") + 2)}
        self.repairs: dict[str, str | None] = {}
        self.clean: set[str] = set()  # tokens as they stand that need no closer look
        self._halves: set[str] | None = None
        self.joins: np.ndarray | None = None
        self._joined: dict[tuple, bool] = {}
        self._learn([w for w in counts if len(w) > 1])

    def _learn(self, tokens: list[str]) -> None:
        for token, offers in zip(tokens, self.editor.proposals(tokens)):
            own = self.counts.get(token, 0)
            least = max(_LEAST, _RATIO * own) * (1 if len(token) > 3 else 5)
            good = [x for x in offers if x != token and len(x) > 1 and self.counts.get(x, 0) >= least]
            if token in self.counts or len(token) < 4:  # a word of its own, unless the misreading is a usual one
                good = [x for x in good if len(token) > 2 and _usual(token, x)]
            if good:
                self.repairs[token] = max(good[:4], key=self.counts.__getitem__)
            elif token not in self.counts:
                self.repairs[token] = None

    def known(self, word: str) -> bool:
        return word in self.counts and word not in self.repairs

    def alone(self, word: str) -> int:
        """How often the word stands, not counting the pieces of words broken at a line's end."""
        return self.counts.get(word, 0) - self.pieces.get(word, 0)

    def split_word(self, left: str, right: str) -> bool:
        """Whether the two are the halves of a word far commoner than the rarer of them."""
        whole = self.counts.get(left + right, 0)
        return whole >= _LEAST and whole >= _RATIO * min(self.alone(left), self.alone(right))

    @property
    def halves(self) -> set[str]:
        """All strings that may be the rarer half of a split word; made where it is used, not sent."""
        if self._halves is None:
            out: set[str] = set()
            for word, n in self.counts.items():
                if n >= _LEAST and "-" not in word:
                    out.update(half for i in range(1, len(word)) for half in (word[:i], word[i:]) if _RATIO * self.alone(half) <= n)
            self._halves = out
        return self._halves

    def prepare(self, texts: list[str]) -> None:
        """Ask the editor about all new words of a batch at once."""
        if len(self.repairs) + len(self.clean) > 1_500_000:  # memory bound; words are asked about again
            self.repairs.clear()
            self.clean.clear()
            self._learn([w for w in self.counts if len(w) > 1])
        fresh: set[str] = set()
        for text in texts:
            fresh.update(text.split())
        fresh -= self.clean
        pieces = {raw: _TOKEN.findall(raw) for raw in fresh}
        low = {t.lower() for found in pieces.values() for t in found}
        self._learn([t for t in low if 1 < len(t) < 40 and t not in self.counts and t not in self.repairs and any(c.isalpha() for c in t)])
        for raw, found in pieces.items():
            bare = len(raw) == 1 and raw.isalpha() and raw not in "aAyYoOeEuUI"  # may be part of a spaced-out word
            part = any(t.lower() in self.halves for t in found)  # may be part of a split word
            if not bare and not part and all(self.fix(t) is None for t in found):
                self.clean.add(raw)

    def fix(self, token: str) -> str | None:
        """The repaired token, or None if there is nothing to repair."""
        low = token.lower()
        if low.isdigit() or len(low) < 2:
            return None
        if low in self.counts and low not in self.repairs:
            return None
        better = self.repairs.get(low)
        if not better or (low[-2:] in ("'s", "’s") and low[:-2] in self.counts):
            return None
        if sum(c.isdigit() for c in low) * 2 > len(low):
            return None
        return better.upper() if token.isupper() and len(token) > 1 else better[0].upper() + better[1:] if token[0].isupper() else better

    def spaced(self, run: str) -> list[str] | None:
        """Words of a spaced-out run, or None if its letters make none."""
        letters = run.replace(" ", "")
        low = letters.lower()
        if self.counts.get(low, 0) >= 5:
            return [letters]
        for i in range(1, len(low)):
            if self.counts.get(low[:i], 0) >= _LEAST and self.counts.get(low[i:], 0) >= _LEAST and (len(low) - i > 1):
                return [letters[:i], letters[i:]]
        return None

    def line(self, line: str) -> tuple[str, bool]:
        """The line with its words repaired, and whether there was any to repair."""
        changed = False

        def close(m: re.Match) -> str:
            nonlocal changed
            found = self.spaced(m[0])
            changed = changed or found is not None
            return m[0] if found is None else " ".join(found)

        def mend(m: re.Match) -> str:
            nonlocal changed
            found = self.fix(m[0])
            changed = changed or found is not None
            return m[0] if found is None else found

        if " " in line:
            line = _SPACED.sub(close, line)
        tokens = line.lower().split(" ")
        if len(tokens) > 1 and any(t.rstrip(".,;:") in self.halves for t in tokens):
            parts = line.split(" ")
            for i in range(len(parts) - 1):
                x, y = parts[i].lower(), parts[i + 1].lower().rstrip(".,;:")
                if x.isalpha() and y.isalpha() and len(x) + len(y) > 4 and parts[i + 1][0].islower() and self.split_word(x, y):
                    parts[i], parts[i + 1], changed = parts[i] + parts[i + 1], "", True
            line = " ".join(p for k, p in enumerate(parts) if p or not changed)
        return _TOKEN.sub(mend, line), changed

    def broken(self, line: str, below: str) -> str | None:
        """The whole word if the line's last word is broken and goes on below, its hyphen taken out."""
        m, rest = _BREAK.search(line), re.match(r"\s*([^\W_]+)", below)
        if not m or not rest:
            return None
        left, right = m[1].split("-")[-1], rest[1]
        if right[0].isupper() and not left.isupper():
            return None
        soft = line.rstrip()[-1] not in "-‐"
        seen = tuple(self.join_features(left.lower(), right.lower(), soft, stem=m[1].lower()))
        if seen not in self._joined:  # features are yes or no, so there are few different ones
            self._joined[seen] = float((_crossed(np.array([seen], np.float64)) @ self.joins)[0]) > 0
        return left + right if self._joined[seen] else None

    def join_features(self, left: str, right: str, soft: bool, stem: str | None = None, hidden: bool = False) -> list[float]:
        whole = 0 if hidden else self.counts.get(left + right, 0)
        compound = f"{stem or left}-{right}" in self.prefixes
        return _join_features(left, right, whole, (self.alone(left), self.alone(right)), (self.known(left), self.known(right)), compound, soft)

    def read(self, text: str, repair: bool = True) -> tuple[list[tuple[int, str]], str | None]:
        """((line number, noise kind) of the text, the text in continuous paragraphs if asked for)."""
        lines = text.split("\n")
        split = [x.split() for x in lines]
        may, f = _line_features(lines, split)
        running = {i for i, good in zip(may, _crossed(f) @ self.furniture > 0) if good} if may else set()
        kinds = [(i, "furniture") for i in sorted(running)]
        body = [i for i in range(len(lines)) if split[i] and i not in running]
        paragraphs, current, joined, last = [], "", "", -1
        for k, i in enumerate(body):
            line = lines[i]
            if repair and current and i > last + 1 and any(not split[j] for j in range(last + 1, i)):
                # a page that ends within a sentence ends no paragraph
                if not any(j in running for j in range(last + 1, i)) or current[-1] in ".:;!?" or not line.lstrip()[:1].islower():
                    paragraphs.append(current)
                    current = ""
            last = i
            clean = self.clean.issuperset(split[i])
            end = split[i][-1][-1]
            below = lines[body[k + 1]] if end in "-‐¬\xad" and k + 1 < len(body) else ""
            whole = self.broken(line, below) if below else None
            if not repair and clean and not whole:
                joined = ""
                continue
            if joined and line.lstrip().startswith(joined):
                line = line.lstrip()[len(joined) :].lstrip()
            joined = ""
            if whole:
                kinds.append((i, "hyphen"))
                joined = re.match(r"\s*([^\W_]+)", below)[1]
                line = line[: _BREAK.search(line).end(1)] + joined
            if clean:
                fixed, changed = line, False
            else:
                fixed, changed = self.line(line)
                if whole:  # the joined word counts only if it is misread itself
                    changed = changed and (self.line(line[: line.rfind(" ") + 1])[1] or self.fix(whole) is not None)
            if changed:
                kinds.append((i, "chars"))
            if repair:
                current = f"{current} {fixed.strip()}".strip()
        if current:
            paragraphs.append(current)
        return kinds, "\n\n".join(paragraphs) if repair else None


def _counted(documents: DataFrame) -> DataFrame:
    """(word, n, pieces): how often each word stands, and how often of that beside a hyphen at a line's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        pieces: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                low = text.lower()
                counts.update(low.split())  # taken apart once for each distinct token
                for end in _LINE_END.finditer(low):
                    left, right = _LAST_WORD.search(low, max(0, end.start() - 40), end.start()), WORDS.match(low, end.end())
                    if left and right:
                        pieces.update((left[0], right[0]))
            if len(counts) > 1_000_000:
                yield rows(counts, pieces)
                counts.clear()
                pieces.clear()
        yield rows(counts, pieces)

    def rows(tokens: Counter[str], pieces: Counter[str]) -> pa.RecordBatch:
        counts: Counter[str] = Counter()
        for token, n in tokens.items():
            for w in WORDS.findall(token):
                counts[w] += n
            if "-" in token:
                for w in _COMPOUND.findall(token):
                    counts[w] += n
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()), pa.array([pieces[w] for w in counts], pa.int64())], names=["word", "n", "pieces"])

    return documents.select("text").where("text is not null").mapInArrow(run, "word string, n long, pieces long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("pieces").alias("pieces"))


def train(documents: DataFrame, lexicon: int = LEXICON_WORDS, words: int = TRAINING_WORDS, sample: int = TRAINING_DOCUMENTS) -> Model:
    """The perceptrons and the dictionary: all words that stand at least 3 times in the documents.
    More than ``lexicon`` of them are an error, as a part of them would make rare words unknown.
    The editor and the line joins are fitted on ``words`` of them, the furniture classifier on the ``sample``
    documents of smallest hash; these two bounds hold whatever the corpus' size."""
    top = _counted(documents).where("n >= 3").orderBy(F.desc("n"), "word").limit(lexicon + 1).collect()
    if len(top) > lexicon:
        raise ValueError(f"more than {lexicon} words stand at least 3 times; give a larger lexicon")
    counts = {r["word"]: r["n"] for r in top}
    pieces = {r["word"]: r["pieces"] for r in top if r["pieces"]}
    compounds = {w for w in counts if "-" in w}
    plain = [w for w in counts if "-" not in w and len(w) > 3 and counts[w] >= _LEAST][:words]
    texts = [r["text"] for r in documents.where("text is not null").select("text", F.xxhash64("doc_id").alias("h")).orderBy("h").limit(sample).collect()]
    editor = Editor.train(plain) if plain else Editor([KEEP, DELETE], np.zeros((_HASH, 2), np.float32))
    model = Model(counts, compounds, editor, _train_furniture(texts), pieces)
    model.joins = _train_joins(model, [w for w in counts if "-" not in w][:words])
    return model


def read_pages(documents: DataFrame, model: Model | None = None, repair: bool = True) -> DataFrame:
    """(doc_id, noise array<struct<line_no, noise_kind>>, text) of every document with a text.

    Noise kinds are ``furniture``, ``hyphen`` and ``chars``; lines are counted from 0 between
    newlines. ``text`` is the repaired text: furniture gone, broken words joined, misread
    ones replaced, lines of a paragraph put together in reading order. Null texts and ids give
    no row; an empty text gives an empty one; repeated rows give repeated rows. Without
    ``repair`` the text is null and only the noise is looked for.
    """
    known = documents.sparkSession.sparkContext.broadcast(model or train(documents))  # bounded by the lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = known.value
        kind = pa.list_(pa.struct([("line_no", pa.int32()), ("noise_kind", pa.string())]))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            reader.prepare(texts)
            done = [reader.read(t, repair) for t in texts]
            noise = [[{"line_no": i, "noise_kind": k} for i, k in kinds] for kinds, _ in done]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(noise, kind), pa.array([t for _, t in done], pa.string())], names=["doc_id", "noise", "text"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "doc_id long, noise array<struct<line_no:int,noise_kind:string>>, text string")
