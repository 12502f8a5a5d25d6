"""A gated recurrent language model in numpy with a class-factored output.

Symbols 0..words-1 are frequent words, in classes of ``width``; the symbols
after them stand for all other words, one per ending, and are the last class.
The chance of a frequent word is that of its class times that of the word in
the class, both from the state; of another word, the model gives the chance of
its ending in the same way (its share of the ending is counted, not learned).  Documents run
side by side in lanes, one after another in each; a lane's state is carried
from window to window and starts anew with a document.
"""

from __future__ import annotations

import heapq

import numpy as np

FLOAT = np.float32


class Shape:
    """Sizes of the parameters, and their places in one vector."""

    def __init__(self, words: int, endings: int, hidden: int = 16, width: int = 64):
        self.words, self.endings, self.hidden, self.width = words, endings, hidden, width
        self.groups = -(-words // width)
        self.classes = self.groups + 1
        self.start = words + endings
        h = hidden
        self.parts = {"input": (words + endings + 1, 3 * h), "gates": (h, 2 * h), "candidate": (h, h),
                      "class_w": (h, self.classes), "class_b": (self.classes,),
                      "word_w": (self.groups, h, width), "word_b": (self.groups, width),
                      "ending_w": (h, endings), "ending_b": (endings,)}
        self.size = sum(int(np.prod(s)) for s in self.parts.values())

    def split(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts.items():
            n = int(np.prod(shape))
            out[name] = vector[at:at + n].reshape(shape)
            at += n
        return out

    def first(self, word_counts: np.ndarray, ending_counts: np.ndarray, seed: int = 11) -> np.ndarray:
        """Starting parameters: the state says nothing yet, biases give the counted shares."""
        vector = np.zeros(self.size, FLOAT)
        p = self.split(vector)
        random = np.random.default_rng(seed)
        for name in ("input", "gates", "candidate", "class_w", "word_w", "ending_w"):
            p[name][...] = random.normal(0, 0.1, p[name].shape)
        grid = np.full(self.groups * self.width, -1e9)
        grid[:self.words] = np.log(word_counts + 0.1)
        p["word_b"][...] = grid.reshape(self.groups, self.width)
        padded = np.zeros(self.groups * self.width)
        padded[:self.words] = word_counts + 0.1
        p["class_b"][...] = np.log(np.append(padded.reshape(self.groups, -1).sum(axis=1), (ending_counts + 0.1).sum()))
        p["ending_b"][...] = np.log(ending_counts + 0.1)
        return vector


class Lanes:
    """Documents (arrays of symbols) dealt to lanes: the next longest to the emptiest lane."""

    def __init__(self, docs: list[np.ndarray], start: int, most: int = 256):
        total, longest = sum(map(len, docs)), max(map(len, docs))
        n = max(1, min(most, len(docs), total // max(longest, 64)))
        free, lanes = [(0, i) for i in range(n)], [[] for _ in range(n)]
        for d in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            used, i = heapq.heappop(free)
            lanes[i].append(d)
            heapq.heappush(free, (used + len(docs[d]), i))
        length = max(sum(len(docs[d]) for d in lane) for lane in lanes)
        self.target = np.full((length, n), -1, np.int32)
        self.input = np.full((length, n), start, np.int32)
        self.doc = np.zeros((length, n), np.int32)
        for i, lane in enumerate(lanes):
            at = 0
            for d in lane:
                end = at + len(docs[d])
                self.target[at:end, i], self.doc[at:end, i] = docs[d], d
                self.input[at + 1:end, i] = docs[d][:-1]
                at = end
        self.begins = self.input == start


# Room for exponentials: sums of a class's outputs stay below 1e38, and outputs may lie 160 apart.
ROOM = FLOAT(75)


def shifted(weights: np.ndarray, biases: np.ndarray) -> np.ndarray:
    """A softmax's weights with its biases as one more row, moved so that no output exceeds ``ROOM``: states are within 1,
    so the weights bound the outputs.  Of several softmaxes at once, each is moved on its own."""
    most = (np.abs(weights).sum(axis=-2) + biases).max(axis=-1, keepdims=True)
    return np.concatenate([weights, (biases + (ROOM - most))[..., None, :]], axis=-2)


def chances(states: np.ndarray, weights: np.ndarray, target: np.ndarray):
    """Log chance of each row's target, the exponentials of all outputs, and their sums."""
    x = states @ weights
    score = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], FLOAT)
    score -= np.log(total)
    return score, x, total


class Model:
    def __init__(self, shape: Shape, vector: np.ndarray):
        self.shape, self.vector = shape, vector.astype(FLOAT)
        self.p = shape.split(self.vector)
        self.softmaxes = None

    def weights(self, fixed: bool):
        """The weights of all softmaxes: of the classes, then of the words of each class, the endings last.  They are made
        once if the parameters are ``fixed``."""
        if self.softmaxes is None or not fixed:
            p = self.p
            words = shifted(p["word_w"], p["word_b"])
            self.softmaxes = shifted(p["class_w"], p["class_b"]), [*words, shifted(p["ending_w"], p["ending_b"])]
        return self.softmaxes

    def states(self, h, inputs, begins, backward: bool = True):
        """States after each step of a window, and what a backward pass needs.

        A lane in which a document begins starts from zero.  Each array of a step lies in one piece, and every step
        writes into the arrays of the window; without a backward pass, into the same ones.
        """
        p, n = self.p, self.shape.hidden
        steps, lanes = inputs.shape
        # sigmoid(x) = 1 / (1 + exp(-x))
        to_update, to_reset, to_candidate = (table[inputs] for table in (
            -p["input"][:, :n], -p["input"][:, n:2 * n], np.ascontiguousarray(p["input"][:, 2 * n:])))
        w_update, w_reset, w_candidate = (np.ascontiguousarray(w) for w in (-p["gates"][:, :n], -p["gates"][:, n:], p["candidate"]))
        after, slots = np.empty((steps, lanes, n), FLOAT), steps if backward else 1
        before, inner, update, reset, candidate = (np.empty((slots, lanes, n), FLOAT) for _ in range(5))
        for t in range(steps):
            b, r, u, f, c = (x[t % slots] for x in (before, inner, update, reset, candidate))
            b[...] = h
            b[begins[t]] = 0
            for gate, weights, x in ((u, w_update, to_update[t]), (f, w_reset, to_reset[t])):
                np.matmul(b, weights, out=gate)
                gate += x
                np.exp(gate, out=gate)
                gate += 1
                np.reciprocal(gate, out=gate)
            np.multiply(f, b, out=r)
            np.matmul(r, w_candidate, out=c)
            c += to_candidate[t]
            np.tanh(c, out=c)
            h = np.subtract(c, b, out=after[t])
            h *= u
            h += b
        return h, (before, after, inner, update, reset, candidate)

    def outputs(self, states, targets, backward: bool, rows=None):
        """Log chance of each target (of its class, and of a frequent word in it); gradients if asked for.

        ``rows``: the places of the states (all) that ``targets`` belong to.  Rows are taken in the order of their targets,
        so those of a class, and those of a word, are runs.  A gradient is that of the chances, whose sums scale the states
        and not the many outputs, less that of the targets, added up per run.
        """
        p, shape, h = self.p, self.shape, self.shape.hidden
        order = np.argsort(targets, kind="stable")
        targets = targets[order]
        s = np.empty((len(order), h + 1), FLOAT)
        s[:, :h], s[:, h] = states[order if rows is None else rows[order]], 1
        of_classes, of_words = self.weights(not backward)
        group = np.where(targets < shape.words, targets // shape.width, shape.groups)
        score, e, total = chances(s, of_classes, group)
        ends = np.searchsorted(group, np.arange(shape.classes + 1))
        if backward:
            inverse = (1 / total)[:, None]
            g_class = (s * inverse).T @ e
            own, first = np.unique(targets, return_index=True)
            per_target = np.add.reduceat(s, first, axis=0)
            classes, begin = np.unique(group[first], return_index=True)
            g_class[:, classes] -= np.add.reduceat(per_target, begin, axis=0).T
            g_states = (e @ p["class_w"].T) * inverse - p["class_w"].T[group]
            g_word = np.zeros((shape.groups, h + 1, shape.width), FLOAT)
            g_ending = np.zeros((h + 1, shape.endings), FLOAT)
        for k in range(shape.classes):
            part = slice(ends[k], ends[k + 1])
            if ends[k] == ends[k + 1]:
                continue
            inside = targets[part] - (k * shape.width if k < shape.groups else shape.words)
            more, e, total = chances(s[part], of_words[k], inside)
            score[part] += more
            if backward:
                inverse = (1 / total)[:, None]
                (g_word[k] if k < shape.groups else g_ending)[...] = (s[part] * inverse).T @ e
                back = of_words[k][:h].T
                g_states[part] += (e @ back) * inverse - back[inside]
        out = np.empty_like(score)
        out[order] = score
        if not backward:
            return out, {}
        words = own < shape.words
        g_word[own[words] // shape.width, :, own[words] % shape.width] -= per_target[words]
        g_ending[:, own[~words] - shape.words] -= per_target[~words].T
        grads = {"class_w": g_class[:h], "class_b": g_class[h], "word_w": g_word[:, :h], "word_b": g_word[:, h],
                 "ending_w": g_ending[:h], "ending_b": g_ending[h], "states": np.empty_like(g_states)}
        grads["states"][order] = g_states
        return out, grads

    def windows(self, lanes: Lanes, steps: int):
        """Windows of all lanes in order, with the state before each; lanes that have ended are left out."""
        h = np.zeros((lanes.target.shape[1], self.shape.hidden), FLOAT)
        for t in range(0, len(lanes.target), steps):
            part = slice(t, t + steps)
            live = np.flatnonzero((lanes.target[part] >= 0).any(axis=0))
            if len(live) < h.shape[0]:
                yield h[live], lanes.input[part][:, live], lanes.begins[part][:, live], lanes.target[part][:, live], \
                    lanes.doc[part][:, live], (h, live)
            else:
                yield h, lanes.input[part], lanes.begins[part], lanes.target[part], lanes.doc[part], (h, live)

    def score(self, docs: list[np.ndarray], steps: int = 64) -> np.ndarray:
        """Natural log chance of every document's symbols (for words that aren't frequent: of their class)."""
        total = np.zeros(len(docs))
        if not docs:
            return total
        lanes = Lanes(docs, self.shape.start)
        for h, inputs, begins, targets, doc, (carried, live) in self.windows(lanes, steps):
            last, (_, after, *_) = self.states(h, inputs, begins, False)
            carried[live] = last
            real = np.flatnonzero(targets.ravel() >= 0)
            score, _ = self.outputs(after.reshape(-1, self.shape.hidden), targets.ravel()[real], False, real)
            total += np.bincount(doc.ravel()[real], weights=score, minlength=len(docs))
        return total

    def train(self, docs: list[np.ndarray], squares: np.ndarray, rate: float, steps: int = 32) -> None:
        """One pass of truncated backpropagation: gradients stop at the start of each window, the state doesn't.

        ``squares`` holds the sums of squared gradients that scale each parameter's steps.
        """
        if not docs:
            return
        lanes = Lanes(docs, self.shape.start)
        for h, inputs, begins, targets, _, (carried, live) in self.windows(lanes, steps):
            last, kept = self.states(h, inputs, begins)
            carried[live] = last
            real = np.flatnonzero(targets.ravel() >= 0)
            n = max(1, len(real))
            _, grads = self.outputs(kept[1].reshape(-1, self.shape.hidden), targets.ravel()[real], True, real)
            gradient = self.backward(inputs, begins, real, kept, grads) / FLOAT(n)
            squares += gradient * gradient
            self.vector -= FLOAT(rate) * gradient / (np.sqrt(squares) + FLOAT(1e-6))

    def backward(self, inputs, begins, real, kept, grads) -> np.ndarray:
        p, n = self.p, self.shape.hidden
        before, after, inner, update, reset, candidate = kept
        steps, lanes = inputs.shape
        out = np.zeros((steps, lanes, n), FLOAT)
        out.reshape(-1, n)[real] = grads["states"]
        d_update, d_reset, d_candidate = (np.empty((steps, lanes, n), FLOAT) for _ in range(3))
        carry, more = np.zeros((lanes, n), FLOAT), np.empty((lanes, n), FLOAT)
        update_t, reset_t, candidate_t = (np.ascontiguousarray(w.T) for w in (p["gates"][:, :n], p["gates"][:, n:], p["candidate"]))
        # What doesn't depend on later steps, for the whole window at once.
        stays = 1 - update
        to_candidate = update * (1 - candidate * candidate)
        to_update = (candidate - before) * update * stays
        to_reset = before * reset * (1 - reset)
        for t in range(steps - 1, -1, -1):
            d, du, df, dc = out[t], d_update[t], d_reset[t], d_candidate[t]
            d += carry
            np.multiply(d, to_candidate[t], out=dc)
            np.multiply(d, to_update[t], out=du)
            np.matmul(dc, candidate_t, out=more)
            np.multiply(more, to_reset[t], out=df)
            np.multiply(more, reset[t], out=carry)
            np.matmul(du, update_t, out=more)
            carry += more
            np.matmul(df, reset_t, out=more)
            carry += more
            d *= stays[t]
            carry += d
            carry[begins[t]] = 0
        flat = np.concatenate([d_update.reshape(-1, n), d_reset.reshape(-1, n), d_candidate.reshape(-1, n)], axis=1)
        vector = np.zeros(self.shape.size, FLOAT)
        q = self.shape.split(vector)
        q["gates"][...] = before.reshape(-1, n).T @ flat[:, :2 * n]
        q["candidate"][...] = inner.reshape(-1, n).T @ flat[:, 2 * n:]
        for name in ("class_w", "class_b", "word_w", "word_b", "ending_w", "ending_b"):
            q[name][...] = grads[name]
        ids = inputs.ravel()
        order = np.argsort(ids, kind="stable")
        distinct, first = np.unique(ids[order], return_index=True)
        q["input"][distinct] = np.add.reduceat(flat[order], first, axis=0)
        return vector
