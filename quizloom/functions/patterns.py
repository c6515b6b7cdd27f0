"""Templates' own patterns, written for Python, in the dialect that runs them here."""

import re
import warnings

_CLASS_ESCAPES = {"[": r"\[", "&": r"\&", "~": r"\~"}


def to_java(pattern: str) -> tuple[str, int]:
    """The pattern for Java's regexes, and its number of capturing groups.

    Differences that change meaning are rewritten: named groups and references to them
    become numbered, ``{,m}`` gets its zero, ``\\Z`` its Java name, and characters that
    only Java treats as operators inside a class are escaped. Raises ``ValueError`` for
    patterns that are not valid or use what Java has no form for.
    """
    try:
        with warnings.catch_warnings():
            # Python warns of what its classes might mean one day.
            warnings.simplefilter("ignore", FutureWarning)
            compiled = re.compile(pattern)
    except (re.error, OverflowError) as error:
        raise ValueError(f"{error}") from None
    out, at, in_class = [], 0, False
    while at < len(pattern):
        rest = pattern[at:]
        if rest[0] == "\\":
            token = rest[:2]
            out.append(r"\z" if token == r"\Z" and not in_class else token)
            at += 2
        elif in_class:
            out.append(_CLASS_ESCAPES.get(rest[0], rest[0]))
            in_class = rest[0] != "]"
            at += 1
        elif rest[0] == "[":
            # A bracket that comes first, also after a caret, is a character.
            head = re.match(r"\[\^?\]?", rest).group()
            out.append(head.replace("]", r"\]"))
            in_class = True
            at += len(head)
        elif named := re.match(r"\(\?P<\w+>", rest):
            out.append("(")
            at += named.end()
        elif back := re.match(r"\(\?P=(\w+)\)", rest):
            out.append(f"(?:\\{compiled.groupindex[back.group(1)]})")
            at += back.end()
        elif rest.startswith("(?#"):
            at += rest.index(")") + 1
        elif rest.startswith("(?("):
            raise ValueError("conditional groups have no Java form")
        elif upto := re.match(r"\{,(\d+)\}", rest):
            out.append(f"{{0,{upto.group(1)}}}")
            at += upto.end()
        else:
            out.append(rest[0])
            at += 1
    return "".join(out), compiled.groups
