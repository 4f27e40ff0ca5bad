"""Brute force for one log partition: what is committed by a time follows from
the set of offsets completed by then, worked out anew for every completion."""


class Result:
    def __init__(self, last, in_flight, completed):
        self.last, self.in_flight, self.completed = last, in_flight, completed


def _prefix_end(base, finished):
    """The largest offset up to which everything above ``base`` is finished."""
    return next(o for o in range(base, base + len(finished) + 1) if o + 1 not in finished)


def run(base, fetched, completions):
    """``completions``: (time, offset) pairs; everything was fetched before.
    Returns (advances, classes, result): advances are (time, through)."""
    order = sorted(completions)
    tracked = {o for o in fetched if o > base}
    ends = [_prefix_end(base, tracked & {o for _, o in order[:k]}) for k in range(len(order) + 1)]
    seen_before = [o in {x for _, x in order[:k]} for k, (_, o) in enumerate(order)]
    classes = [(o, t, "noop_committed" if o <= ends[k] else
                "error_not_in_flight" if o not in tracked else
                "error_double" if seen_before[k] else "ok") for k, (t, o) in enumerate(order)]
    advances = [(order[k][0], b) for k, (a, b) in enumerate(zip(ends, ends[1:])) if a != b]
    finished = tracked & {o for _, o in order}
    last = ends[-1]
    return advances, classes, Result(last, {o for o in tracked - finished if o > last}, {o for o in finished if o > last})
