"""Column functions on game records: headers, results, move tokens, state keys, encodings and texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
PIECES = "PNBRQKpnbrqk"
FILES = "abcdefgh"
RESULTS = {"1-0": 1.0, "0-1": 0.0, "1/2-1/2": 0.5}
BUCKETS = ((1200, "Novice"), (1600, "Intermediate"), (2000, "Advanced"))
TOP_BUCKET = "Expert"
MOVE = "^[a-h][1-8][a-h][1-8]"


def _parts(text: Column) -> Column:
    """What is before and after the first empty line of a game."""
    return F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\n[ \t]*\n", 2)


def header_lines(text: Column) -> Column:
    """The header lines of a game: those before the first empty line."""
    return F.get(_parts(text), F.lit(0))


def header(text: Column, name: str, default: str) -> Column:
    """The value of a header; the last one of a repeated header; ``default`` if there is none."""
    found = F.regexp_extract_all(header_lines(text), F.lit(rf'(?m)^\[{name} "(.*)"\][ \t]*$'), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(default))


def whole_number(text: Column) -> Column:
    """``text`` as an integer, blanks around and a sign allowed; null for anything else."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("int"))


def result_score(result: Column) -> Column:
    """1.0, 0.0 or 0.5 for a decided result, else null."""
    out = F.lit(None).cast("double")
    for name, score in RESULTS.items():
        out = F.when(result == name, F.lit(score)).otherwise(out)
    return out


def main_line(moves: Column) -> Column:
    """``moves`` without its variations, however deep they are nested.

    The text is cut before every parenthesis, and one pass carries the depth: what stands at depth 0 stays. A ")" that
    closes nothing is dropped; a "(" that is never closed takes the rest.
    """
    parts = F.split(moves, r"(?=[()])")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("kept"))

    def step(at: Column, part: Column) -> Column:
        # An opening parenthesis goes one down, a closing one up, and the first part of a text may begin with neither.
        turn = F.when(part.startswith("("), 1).when(part.startswith(")"), -1).otherwise(0)
        depth = F.greatest(F.lit(0), at.depth + turn)
        return F.struct(depth.alias("depth"), F.when(depth == 0, F.concat(at.kept, F.lit(" "), F.ltrim(part, F.lit("()")))).otherwise(at.kept).alias("kept"))

    return F.when(moves.rlike("[()]"), F.aggregate(parts, start, step, lambda at: at.kept)).otherwise(moves)


def movetext_tokens(text: Column) -> Column:
    """The moves of a game's text in order: no comments, variations (of any depth), marks, numbers or result.

    A "{" that is never closed takes the rest of the text.
    """
    moves = F.coalesce(F.get(_parts(text), F.lit(1)), F.lit(""))
    moves = main_line(F.regexp_replace(moves, r"\{[^}]*(\}|$)|;[^\n]*", " "))
    moves = F.regexp_replace(moves, r"\$[0-9]+|[0-9]+\.+", " ")
    tokens = F.filter(F.split(moves, r"\s+"), lambda t: (t != "") & ~t.isin("1-0", "0-1", "1/2-1/2", "*"))
    return F.transform(tokens, lambda t: F.regexp_replace(t, r"[!?]+$", ""))


def state_key(state: Column) -> Column:
    """The first four fields of a trimmed state text."""
    return F.array_join(F.slice(F.split(F.trim(state), " "), 1, 4), " ")


def mover_rating(first_moves: Column, first: Column, second: Column) -> Column:
    return F.when(first_moves, first).otherwise(second)


def mover_outcome(first_moves: Column, outcome: Column) -> Column:
    """The outcome as the mover sees it."""
    return F.when(first_moves, outcome).otherwise(1.0 - outcome)


def rating_bucket(rating: Column) -> Column:
    """The name of a rating's bucket; a null rating falls in the top one."""
    out = F.lit(TOP_BUCKET)
    for below, name in reversed(BUCKETS):
        out = F.when(rating < below, F.lit(name)).otherwise(out)
    return out


def smoothed(wins: Column, games: Column, prior: float = 5.0, weight: float = 10.0) -> Column:
    return (wins + prior) / (games + weight)


def blended(rate: Column, rating: Column, share: Column) -> Column:
    """Half the rate, three tenths of the rating over 3000 and a fifth of the share."""
    return rate * 0.5 + (rating / 3000.0) * 0.3 + share * 0.2


def percent_number(share: Column) -> Column:
    return F.round(share * 100, 1).cast("string")


def explanation(games: Column, rate: Column, expert_rate: Column) -> Column:
    tail = F.concat(F.lit("Experts win with this "), percent_number(expert_rate), F.lit("% of the time."))
    return F.concat(
        F.lit("Based on "),
        games.cast("string"),
        F.lit(" games, this move has a "),
        percent_number(rate),
        F.lit("% global success rate. "),
        F.coalesce(tail, F.lit("Limited data at expert levels.")),
    )


def _square(move: Column, at: int) -> Column:
    """0..63 of the square that begins at character ``at`` of a move text."""
    return (F.substring(move, at + 1, 1).try_cast("int") - 1) * 8 + F.ascii(F.substring(move, at, 1)) - ord(FILES[0])


def move_index(move: Column) -> Column:
    """from * 64 + to, promotions ignored; null if either square is bad."""
    return F.when(move.rlike(MOVE), _square(move, 1) * 64 + _square(move, 3))


def board_squares(state: Column) -> Column:
    """The 64 squares of a board text, from the top left, "." for an empty one."""
    board = F.replace(F.substring_index(state, " ", 1), F.lit("/"), F.lit(""))
    for n in range(8, 0, -1):
        board = F.replace(board, F.lit(str(n)), F.lit("." * n))
    return board


#: What stands on a square, empty first; its place here is its digit in a packed board.
SQUARES = f".{PIECES}"
DIGITS = "0123456789ABC"


def is_board(state: Column) -> Column:
    """Whether the board of a state has 64 squares, each empty or with a known piece."""
    return board_squares(state).rlike(f"^[{SQUARES}]{{64}}$")


def packed_board(state: Column) -> Column:
    """A board in 32 bytes, four bits for each square from the top left; null for a bad board.

    It holds what 768 numbers do: the form to store, to shuffle and to compare. Batches of boards are packed at once.
    """
    # A function within a function travels by value, so executors need no copy of this module.
    digit = np.full(256, 255, np.uint8)
    digit[np.frombuffer(SQUARES.encode(), np.uint8)] = np.arange(len(SQUARES), dtype=np.uint8)

    @F.arrow_udf("binary")
    def pack(boards: pa.Array) -> pa.Array:
        squares = pc.replace_substring(boards.cast(pa.string()), "/", "")
        for n in range(8, 0, -1):
            squares = pc.replace_substring(squares, str(n), "." * n)
        whole = np.flatnonzero(pc.fill_null(pc.equal(pc.binary_length(squares), 64), False).to_numpy(zero_copy_only=False))
        text = "".join(squares.take(pa.array(whole)).to_pylist()).encode()
        digits = digit[np.frombuffer(text, np.uint8)].reshape(-1, 64)
        good = (digits < 255).all(axis=1)
        valid = np.zeros(len(squares), bool)
        valid[whole[good]] = True
        digits = digits[good]
        ends = np.concatenate([[0], np.cumsum(32 * valid)]).astype(np.int32)
        data = (digits[:, ::2] << 4 | digits[:, 1::2]).tobytes()
        return pa.Array.from_buffers(pa.binary(), len(squares), [pa.py_buffer(np.packbits(valid, bitorder="little")), pa.py_buffer(ends), pa.py_buffer(data)])

    return pack(F.substring_index(state, " ", 1))


def board_digits():
    """A function that gives the 64 digits of each packed board that is there, as rows of an array. It travels by value."""

    def digits(boards: pa.Array):
        raw = np.frombuffer(b"".join(boards.drop_null().to_pylist()), np.uint8)
        return np.stack([raw >> 4, raw & 15], axis=1).reshape(-1, 64)

    return digits


def unpacked_planes(packed: Column) -> Column:
    """The planes of a packed board, as ``onehot_planes`` gives them."""
    digits, count = board_digits(), len(PIECES)

    @F.arrow_udf("array<float>")
    def flattened(boards: pa.Array) -> pa.Array:
        there = boards.is_valid().to_numpy(zero_copy_only=False)
        numbers = (digits(boards)[:, None, :] == np.arange(1, count + 1, dtype=np.uint8)[:, None]).astype(np.float32).ravel()
        ends = np.concatenate([[0], np.cumsum(64 * count * there)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers), mask=pa.array(~there))

    return flattened(packed)


def onehot_planes(state: Column) -> Column:
    """12 planes of 8 x 8, flattened: plane by piece, row from the top, 1.0 where the piece stands. Null for a bad board."""
    return unpacked_planes(packed_board(state))


def planes_text(planes: Column) -> Column:
    """The numbers of an array that holds nothing but 1.0 and 0.0, as a text of "1" and "0"."""

    @F.arrow_udf("string")
    def text(numbers: pa.Array) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(numbers), 0).to_numpy())]).astype(np.int32)
        data = (numbers.flatten().to_numpy() + ord("0")).astype(np.uint8).tobytes()
        valid = np.packbits(numbers.is_valid().to_numpy(zero_copy_only=False), bitorder="little")
        return pa.Array.from_buffers(pa.string(), len(numbers), [pa.py_buffer(valid), pa.py_buffer(ends), pa.py_buffer(data)])

    return text(planes)


def set_squares(packed: Column) -> Column:
    """Which of the 768 numbers of a packed board's planes are 1: one for each piece on the board, by square."""
    place = F.transform(F.split(F.hex(packed), ""), lambda d, i: F.when(d != "0", (F.instr(F.lit(DIGITS), d) - 2) * 64 + i))
    return F.filter(place, lambda i: i.isNotNull())


def reshape_planes(flat: Column) -> Column:
    """A flat array of 768 as 12 x 8 x 8; a null array has rows that are null."""

    @F.arrow_udf("array<array<array<float>>>")
    def cube(numbers: pa.Array) -> pa.Array:
        there = np.repeat(numbers.is_valid().to_numpy(zero_copy_only=False), 96)
        ends = np.concatenate([[0], np.cumsum(8 * there)]).astype(np.int32)
        rows = pa.ListArray.from_arrays(pa.array(ends), numbers.flatten(), mask=pa.array(~there))
        planes = pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) + 1, 8, dtype=np.int32)), rows)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(planes) + 1, 12, dtype=np.int32)), planes)

    return cube(flat)


def ai_sentence(confidence: Column) -> Column:
    return F.concat(
        F.lit("The classifier selected this move with "),
        F.format_number(confidence * 100, 1),
        F.lit("% confidence based on strategic pattern recognition of Expert play."),
    )
