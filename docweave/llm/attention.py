"""A small causal self-attention model over token classes, in numpy: scoring and training steps.

Subword ids fall into classes; the most frequent ids are classes of their own. Classes fall into
groups of equal size. The probability of an id is that of its class's group given the ids before,
times that of the class within the group, times the id's share of the class in the training
counts. The class before enters directly, and one attention head looks back over the window."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from docweave.llm.common import spans

GROUPS, MEMBERS = 16, 12
CLASSES = GROUPS * MEMBERS
SINGLE = 174              # ids with a class of their own
HEAD = 8
WINDOW = 32
STRIDE = 24               # each later window scores its last STRIDE positions
AT_ONCE = 256             # windows scored together
BLOCK = 128               # windows whose attention is computed together
MOST = 80                 # logits beyond it, either way, count as it
_CAUSAL = np.tri(WINDOW, dtype=np.float32)
_BACK = np.maximum(0, np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :])

SHAPES = {"query": (CLASSES, HEAD), "key": (CLASSES, HEAD), "value": (CLASSES, HEAD), "near": (WINDOW,),
          "group": (HEAD, GROUPS), "direct_group": (CLASSES, GROUPS),
          "member": (GROUPS, HEAD, MEMBERS), "direct": (CLASSES, GROUPS, MEMBERS)}


@dataclass
class Model:
    class_of: np.ndarray      # class of each id
    in_class: np.ndarray      # natural log of the id's share of its class
    weights: dict[str, np.ndarray]


def vocabulary(counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each id, log share within it, and log share of each class. The end has class 0,
    the next most frequent ids one each, the others share classes of about equal counts."""
    n = counts + 1.0
    order = np.argsort(-counts, kind="stable")
    order = order[order != end_id]
    class_of = np.zeros(len(counts), np.int16)
    class_of[order[:SINGLE]] = np.arange(1, len(order[:SINGLE]) + 1)
    rest, bins = order[SINGLE:], CLASSES - SINGLE - 1
    if len(rest):
        part = (np.cumsum(n[rest]) - 1e-9) / n[rest].sum() * bins
        class_of[rest] = SINGLE + 1 + np.minimum(bins - 1, part.astype(int))
    totals = np.bincount(class_of, n, CLASSES)
    return class_of, np.log(n / totals[class_of]), np.log(np.maximum(totals, 1e-20) / totals.sum())


def start_weights(log_share: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(9)
    weights = {name: rng.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()}
    share = np.exp(log_share).reshape(GROUPS, MEMBERS)
    group = share.sum(axis=1)
    weights["direct_group"] = np.tile(np.log(group), (CLASSES, 1)).astype(np.float32)
    weights["direct"] = np.tile(np.log(share / group[:, None]), (CLASSES, 1, 1)).astype(np.float32)
    weights["near"] = np.zeros(WINDOW, np.float32)
    return weights


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in SHAPES]).astype(np.float32)


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def _across(table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rows of the table for windows of classes, as the columns of one matrix for each window."""
    return table.T.take(classes, axis=1).transpose(1, 0, 2)


def _longest(rows: np.ndarray) -> float:
    return math.sqrt(float((rows.astype(float) ** 2).sum(axis=-1).max()))


def _limited(x: np.ndarray, most: float, bound: float) -> np.ndarray:
    """x within -most and most; `bound` is one that x surely keeps, so that often nothing is to be done."""
    return x if bound < most else np.clip(x, -most, most, out=x)


@dataclass
class Tables:
    """What a step or block reads of the weights: value vectors with a 1 that sums weights, what distance adds to the
    logarithm of a weight, and bounds that the products and logits surely keep."""

    value: np.ndarray
    near: np.ndarray
    bound: float
    most_group: float
    most_member: float


def tables(w: dict[str, np.ndarray]) -> Tables:
    kind = w["query"].dtype
    # a context is a mean of values, so no longer than the longest
    most = [1.001 * (float(np.abs(w[direct]).max()) + _longest(w["value"]) * _longest(columns))
            for direct, columns in (("direct_group", w["group"].T), ("direct", w["member"].transpose(0, 2, 1)))]
    return Tables(np.column_stack((w["value"], np.ones(CLASSES, kind))),
                  np.where(_CAUSAL > 0, w["near"][_BACK], -np.inf).astype(kind),
                  1.001 * _longest(w["query"]) * _longest(w["key"]), *most)


def attend(w: dict[str, np.ndarray], before: np.ndarray, first: int = 0, stop: int = WINDOW,
           held: Tables | None = None) -> tuple[np.ndarray, ...]:
    """Attention over windows of classes (windows x WINDOW) for the places from `first` to `stop`: context vectors, and
    what the backward pass needs: weights before they are divided, and what each was divided by."""
    held, seen = held or tables(w), before[:, :stop]
    scores = np.matmul(w["query"].take(before[:, first:stop], axis=0), _across(w["key"], seen))
    _limited(scores, 30, held.bound)
    scores += held.near[first:stop, :stop]
    np.exp(scores, out=scores)
    sums = np.matmul(scores, held.value.take(seen, axis=0))
    return sums[:, :, :HEAD] / sums[:, :, HEAD:], scores, sums[:, :, HEAD:]


def blocks(n: int, first: int = 0) -> list[tuple[slice, int, int]]:
    """Windows and the places of them, from `first` on, whose attention is computed together: few enough for a core's
    cache, and the places of the first half look at fewer."""
    half = (first + WINDOW) // 2
    return [(slice(i, i + BLOCK), *part) for i in range(0, n, BLOCK) for part in ((first, half), (half, WINDOW))]


def contexts(w: dict[str, np.ndarray], held: Tables, before: np.ndarray, first: int = 0) -> np.ndarray:
    """Context vectors of all places from `first` on."""
    out = np.empty((len(before), WINDOW - first, HEAD), w["query"].dtype)
    for some, start, stop in blocks(len(before), first):
        out[some, start - first:stop - first] = attend(w, before[some], start, stop, held)[0]
    return out


def by_group(before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of places by group and then by the class before, and the slice of each group in it."""
    group = after // MEMBERS
    order = np.argsort((group * CLASSES + before).astype(np.int16), kind="stable")
    borders = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=GROUPS)))).tolist()
    return order, [(n, slice(i, j)) for n, (i, j) in enumerate(zip(borders, borders[1:])) if i < j]


def group_logits(w: dict[str, np.ndarray], held: Tables, context: np.ndarray, before: np.ndarray) -> np.ndarray:
    out = context @ w["group"]
    out += w["direct_group"].take(before, axis=0)
    return _limited(out, MOST, held.most_group)


def member_logits(w: dict[str, np.ndarray], held: Tables, context: np.ndarray, cell: np.ndarray,
                  groups: list[tuple[int, slice]]) -> np.ndarray:
    """Of positions in order of the group; a cell is the class before and the group."""
    out = w["direct"].reshape(-1, MEMBERS).take(cell, axis=0)
    for n, some in groups:
        out[some] += context[some] @ w["member"][n]
    return _limited(out, MOST, held.most_member)


def picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of each row at one place."""
    target = logits.ravel()[np.arange(len(logits)) * logits.shape[1] + at]
    return target - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], logits.dtype))


def log_probabilities(w: dict[str, np.ndarray], before: np.ndarray, after: np.ndarray, wanted: np.ndarray,
                      first: int = 0, held: Tables | None = None) -> np.ndarray:
    """Natural log probability of the classes `after` at the wanted positions, all at `first` or later in their window."""
    held = held or tables(w)
    context = contexts(w, held, before, first).reshape(-1, HEAD)
    place = np.flatnonzero(wanted[:, first:])
    before, after = before[:, first:].ravel(), after[:, first:].ravel()
    order, groups = by_group(before[place], after[place])
    place = place[order]
    context, own, target = context.take(place, axis=0), before[place], after[place]
    group = target // MEMBERS
    found = picked(group_logits(w, held, context, own), group)
    found += picked(member_logits(w, held, context, own * GROUPS + group, groups), target % MEMBERS)
    out = np.empty_like(found)
    out[order] = found
    return out


def line_scores(w: dict[str, np.ndarray], flat: np.ndarray, first: np.ndarray, counts: np.ndarray,
                later: np.ndarray) -> np.ndarray:
    """Natural log probability of lines of classes. Line i predicts the `counts[i]` classes after place
    `first[i]` of `flat`; the one at that place only comes before them. Windows overlap, so that a position sees at least
    WINDOW - STRIDE places of its line, or its whole start, and every position is scored in one window.
    With `later`, the line goes on from another one, which has scored its first WINDOW - STRIDE positions."""
    seen = WINDOW - STRIDE
    windows = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    windows[later & (counts <= seen)] = 0
    of = np.repeat(np.arange(len(counts)), windows)
    number = spans(np.zeros(len(counts), np.int64), windows)
    start, stop = first[of] + number * STRIDE, (first + counts)[of]
    fresh = np.where((number > 0) | later[of], seen, 0)
    out, place, held = np.zeros(len(counts)), np.arange(WINDOW), tables(w)
    for begin in (0, seen):  # windows that score all their positions, and the others
        windows = np.flatnonzero(fresh == begin)
        for at in range(0, len(windows), AT_ONCE):
            some = windows[at:at + AT_ONCE]
            index = start[some, None] + place
            wanted = (place >= begin) & (index < stop[some, None])
            index = np.minimum(index, len(flat) - 2)
            found = log_probabilities(w, flat[index].astype(np.intp), flat[index + 1].astype(np.intp), wanted, begin, held)
            out += np.bincount(np.repeat(of[some], wanted.sum(axis=1)), found, len(counts))
    return out


def score(model: Model, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Natural log probability of each sequence of ids (none empty)."""
    counts = np.diff(starts)
    flat = np.insert(model.class_of[ids], starts[:-1], 0)
    inside = np.bincount(np.repeat(np.arange(len(counts)), counts), model.in_class[ids], len(counts))
    return inside + line_scores(model.weights, flat, starts[:-1] + np.arange(len(counts)), counts,
                                np.zeros(len(counts), bool))


def by_class(classes: np.ndarray) -> np.ndarray:
    return np.argsort(classes.astype(np.uint8), kind="stable")


def sums_by(keys: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each key below `size`; keys must ascend."""
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    if len(keys):
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        out[keys[first]] = np.add.reduceat(rows, first, axis=0)
    return out


def gradients(w: dict[str, np.ndarray], before: np.ndarray, after: np.ndarray,
              wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the wanted positions and its gradients. Positions are put in order of the group
    to predict and the class before, so that each group is a slice, and gradients by class are sums over runs of
    equal keys. Attention goes by blocks of windows that stay in a core's cache."""
    before, after = before.astype(np.intp), after.astype(np.intp)
    held, parts = tables(w), blocks(len(before))
    kept, context = [], np.empty((*before.shape, HEAD), w["query"].dtype)
    for some, first, stop in parts:
        context[some, first:stop], *rest = attend(w, before[some], first, stop, held)
        kept.append(rest)
    place = np.flatnonzero(wanted)
    order, slices = by_group(before.ravel()[place], after.ravel()[place])
    place = place[order]
    flat, own, target = context.reshape(-1, HEAD).take(place, axis=0), before.ravel()[place], after.ravel()[place]
    group = target // MEMBERS
    scale = flat.dtype.type(1 / max(1, len(place)))
    at = np.arange(len(place))
    loss, g = 0.0, {"member": np.zeros_like(w["member"])}

    def step(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Adds to the loss; turns logits into its gradient by them."""
        nonlocal loss
        np.exp(logits, out=logits)
        sums = logits @ np.ones(logits.shape[1], logits.dtype)
        cell = at * logits.shape[1] + target
        line = logits.reshape(-1)
        loss -= float(np.log(line[cell] / sums + 1e-12).sum() * scale)
        logits *= (scale / sums)[:, None]
        line[cell] -= scale
        return logits

    p = step(group_logits(w, held, flat, own), group)
    g["group"] = flat.T @ p
    order = by_class(own)
    g["direct_group"] = sums_by(own[order], p.take(order, axis=0), CLASSES)
    d_flat = p @ w["group"].T
    p = step(member_logits(w, held, flat, own * GROUPS + group, slices), target % MEMBERS)
    for n, some in slices:
        g["member"][n] = flat[some].T @ p[some]
        d_flat[some] += p[some] @ w["member"][n].T
    g["direct"] = sums_by(group * CLASSES + own, p, GROUPS * CLASSES).reshape(GROUPS, CLASSES, MEMBERS).transpose(1, 0, 2)
    d_context = np.zeros_like(context)
    d_context.reshape(-1, HEAD)[place] = d_flat
    # what is taken away: the sum of d_share * share over the places looked at
    away = ((d_context * context).reshape(-1, HEAD) @ np.ones(HEAD, flat.dtype)).reshape(before.shape)
    by_place, near = np.zeros((*before.shape, 3 * HEAD), flat.dtype), np.zeros((WINDOW, WINDOW), flat.dtype)
    for (some, first, stop), (scores, divisor) in zip(parts, kept):
        c, d = before[some], d_context[some, first:stop] / divisor
        d_scores = np.matmul(d, _across(w["value"], c[:, :stop]))
        d_scores -= away[some, first:stop, None] / divisor
        d_scores *= scores
        near[first:stop, :stop] += d_scores.sum(axis=0)
        np.matmul(d_scores, w["key"].take(c[:, :stop], axis=0), out=by_place[some, first:stop, :HEAD])
        by_place[some, :stop, HEAD:2 * HEAD] += np.matmul(
            d_scores.transpose(0, 2, 1), w["query"].take(c[:, first:stop], axis=0))
        by_place[some, :stop, 2 * HEAD:] += np.matmul(scores.transpose(0, 2, 1), d)
    g["near"] = np.bincount(_BACK.ravel(), near.ravel(), WINDOW).astype(flat.dtype)
    order = by_class(before.ravel())
    sums = sums_by(before.ravel()[order], by_place.reshape(-1, 3 * HEAD).take(order, axis=0), CLASSES)
    g["query"], g["key"], g["value"] = np.split(sums, 3, axis=1)
    return loss, g


def train(w: dict[str, np.ndarray], before: np.ndarray, after: np.ndarray, wanted: np.ndarray,
          batch: int = 256, least_steps: int = 150, rate: float = 0.02) -> dict[str, np.ndarray]:
    """Adam over minibatches of windows, in a fixed shuffled order, at least `least_steps`."""
    flat = np.concatenate([w[n].ravel() for n in SHAPES])
    w, first, second = unpacked(flat), np.zeros_like(flat), np.zeros_like(flat)  # w: views of flat
    rng, step = np.random.default_rng(1), 0
    total = max(least_steps, -(-len(before) // batch))
    while step < total:
        order = rng.permutation(len(before))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            _, g = gradients(w, before[some], after[some], wanted[some])
            g = np.concatenate([g[n].ravel() for n in SHAPES])
            step += 1
            pace = rate * (1 - 0.9 * step / total) * math.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
            first *= 0.9
            first += 0.1 * g
            second *= 0.99
            second += 0.01 * g ** 2
            flat -= pace * first / (np.sqrt(second) + 1e-6)
            if step >= total:
                break
    return w
