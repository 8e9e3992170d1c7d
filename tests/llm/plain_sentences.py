"""Sentence splitting with learned rows in memory: the plain version that the joins are tested against."""

from dataclasses import dataclass, field

from tessera.llm import sentences as S


@dataclass
class Model:
    joint: dict = field(default_factory=dict)
    pairs: dict = field(default_factory=dict)
    opens: dict = field(default_factory=dict)
    seen: set = field(default_factory=set)


def model_of(rows):
    m = Model()
    for what, key, w, x, v in rows:
        if what == "joint":
            m.joint[key, w] = v
        elif what == "pair":
            m.pairs[key, w, x] = min(v >= 0.5, m.pairs.get((key, w, x), True))
        elif what == "open":
            m.opens[key, x] = v
        else:
            m.seen.add((key, w))
    return m


def ends(ask, m):
    rule, key, scr, w, x, digit = ask
    keys = (key, scr)
    opens = any(m.opens.get((k, x), 0) > 0 for k in keys)

    def abbreviation():
        for k in keys:
            if (k, w) in m.joint or (k, w) in m.seen:
                return (k, w) in m.joint
        return S.lone_letter(w)

    def learned():
        flagged = False
        for k in keys:
            if (known := m.pairs.get((k, w, x))) is not None:
                return known
            if (k, w) in m.joint:
                flagged = True
                if digit:
                    return False
                if (k, x) in m.opens:
                    return m.joint[k, w] >= 0.05
            elif (k, w) in m.seen:
                return True
        if flagged or S.lone_letter(w):
            return False
        return not digit and opens if S._DOTTED.fullmatch(w) else True

    return {S.OPENS: lambda: opens, S.NO_ABBREVIATION: lambda: not abbreviation(), S.EITHER: lambda: not abbreviation() or learned(), S.LEARNED: learned}[rule]()


def split(text, lang, model):
    p = S.parse(text, lang)
    return [] if p is None else S.spans(p.first, p.last, [(a, b) for a, b, ask in p.cuts if ask < 0 or ends(p.asks[ask], model)])
