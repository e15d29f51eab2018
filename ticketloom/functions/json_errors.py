"""What Python's ``json.loads`` says about a text that is no JSON: the first error's message, line, column
and character, as a column expression.

The text is cut into lexemes by one pattern and a fold carries the decoder's state over them: the
stack of open brackets and what may come next."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_IN_STRING = r'[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+'
_LITERAL = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+|null|true|false|NaN|-?Infinity"
# a whole string, all from a string that goes wrong, blanks, a literal, any other character
_LEXEME = rf'(?s)"{_IN_STRING}"|".*|[ \t\n\r]++|{_LITERAL}|.'

# What may come next: a value; a value or the end of a new array; a value after a comma; a key or the end of
# a new object; a key after a comma; a colon; a comma or a closing bracket; nothing.
VALUE, FIRST, NEXT, KEY, NEXT_KEY, COLON, MORE, END = "V", "F", "N", "K", "k", ":", ",", "."

# The decoder's messages.
NO_VALUE = "Expecting value"
NO_KEY = "Expecting property name enclosed in double quotes"
NO_COLON = "Expecting ':' delimiter"
NO_COMMA = "Expecting ',' delimiter"
EXTRA = "Extra data"
COMMA_IN_OBJECT = "Illegal trailing comma before end of object"
COMMA_IN_ARRAY = "Illegal trailing comma before end of array"
UNTERMINATED = "Unterminated string starting at"
CONTROL = "Invalid control character at"
ESCAPE = "Invalid \\escape"
UNICODE_ESCAPE = "Invalid \\uXXXX escape"
BOM = "Unexpected UTF-8 BOM (decode using utf-8-sig)"


def _string_fault(t: Column, pos: Column) -> Column:
    """``struct(message, at)`` of a lexeme that starts a string and does not end it well."""
    n = F.length(F.regexp_extract(t, rf'^"{_IN_STRING}', 0))
    at, after = F.substring(t, n + 1, F.lit(1)), F.substring(t, n + 2, F.lit(1))
    fault = lambda message, where: F.struct(F.lit(message).alias("message"), where.cast("int").alias("at"))
    # the text may not end right after the digits
    cut = (at == "") & t.rlike(r"(?<!\\)(?:\\\\)*+\\u[0-9a-fA-F]{4}\z")
    return (F.when(cut, fault(UNICODE_ESCAPE, pos + n - 5))
            .when((at == "") | ((at == "\\") & (after == "")), fault(UNTERMINATED, pos))
            .when((at == "\\") & (after == "u"), fault(UNICODE_ESCAPE, pos + n + 1))
            .when(at == "\\", fault(ESCAPE, pos + n)).otherwise(fault(CONTROL, pos + n)))


def first_error(text: Column, trailing_comma: bool = True) -> Column:
    """``struct(message, at)``, at being the character counted from 0; null for JSON and for null.

    ``trailing_comma``: name a comma before a closing bracket as Python 3.13 and later do; else as before,
    where the bracket stands in place of a key or value."""
    none = F.lit(None).cast("struct<message:string,at:int>")
    fault = lambda message, at: F.struct(F.lit(message).alias("message"), at.cast("int").alias("at"))
    state = lambda pos, stack, want, comma, error: F.struct(
        pos.cast("int").alias("pos"), stack.alias("stack"), want.alias("want"), comma.cast("int").alias("comma"), error.alias("error"))

    def step(acc, t):
        pos, stack, want, comma = acc["pos"], acc["stack"], acc["want"], acc["comma"]
        after = pos + F.length(t)
        first = F.substring(t, 1, 1)
        is_string = first == '"'
        whole = is_string & t.rlike(rf'^"{_IN_STRING}"\z')
        literal = t.rlike(rf"^(?:{_LITERAL})\z")
        inside = F.when(F.endswith(stack, F.lit("{")), "{").when(F.endswith(stack, F.lit("[")), "[").otherwise("")
        then = F.when(stack == "", END).otherwise(MORE)                  # after a value
        popped = F.substring(stack, F.lit(1), F.length(stack) - 1)
        closed = state(after, popped, F.when(F.length(stack) <= 1, END).otherwise(MORE), comma, none)
        on = lambda to: state(after, stack, to if isinstance(to, Column) else F.lit(to), comma, none)
        bad = lambda e: state(pos, stack, want, comma, e)
        value = (F.when(whole | literal, on(then)).when(is_string, bad(_string_fault(t, pos)))
                 .when(t == "{", state(after, F.concat(stack, t), F.lit(KEY), comma, none))
                 .when(t == "[", state(after, F.concat(stack, t), F.lit(FIRST), comma, none))
                 .otherwise(bad(fault(NO_VALUE, pos))))
        key = (F.when(whole, on(COLON)).when(is_string, bad(_string_fault(t, pos))).otherwise(bad(fault(NO_KEY, pos))))
        more = (F.when((t == ",") & (inside == "{"), state(after, stack, F.lit(NEXT_KEY), pos, none))
                .when((t == ",") & (inside == "["), state(after, stack, F.lit(NEXT), pos, none))
                .when(((t == "}") & (inside == "{")) | ((t == "]") & (inside == "[")), closed)
                .otherwise(bad(fault(NO_COMMA, pos))))
        out = (F.when(acc["error"].isNotNull(), acc).when(first.isin(" ", "\t", "\n", "\r"), on(want))
               .when(((want == FIRST) & (t == "]")) | ((want == KEY) & (t == "}")), closed))
        if trailing_comma:
            out = (out.when((want == NEXT) & (t == "]"), bad(fault(COMMA_IN_ARRAY, comma)))
                   .when((want == NEXT_KEY) & (t == "}"), bad(fault(COMMA_IN_OBJECT, comma))))
        return (out.when(want.isin(VALUE, FIRST, NEXT), value).when(want.isin(KEY, NEXT_KEY), key)
                .when(want == COLON, F.when(t == ":", on(VALUE)).otherwise(bad(fault(NO_COLON, pos))))
                .when(want == MORE, more).otherwise(bad(fault(EXTRA, pos))))

    def finish(acc):
        want, pos = acc["want"], acc["pos"]
        return (F.when(acc["error"].isNotNull(), acc["error"]).when(want == END, none)
                .when(want.isin(KEY, NEXT_KEY), fault(NO_KEY, pos)).when(want == COLON, fault(NO_COLON, pos))
                .when(want == MORE, fault(NO_COMMA, pos)).otherwise(fault(NO_VALUE, pos)))
    start = state(F.lit(0), F.lit(""), F.lit(VALUE), F.lit(0), none)
    found = F.aggregate(F.regexp_extract_all(text, F.lit(_LEXEME), F.lit(0)), start, step, finish)
    return F.when(F.startswith(text, F.lit("\ufeff")), fault(BOM, F.lit(0))).otherwise(found)


def error_text(text: Column, error: Column) -> Column:
    """``str`` of the decoder's exception: message, line, column and character."""
    before = F.substring(text, F.lit(1), error["at"])
    line = F.length(before) - F.length(F.replace(before, F.lit("\n"))) + 1
    column = F.length(F.substring_index(before, "\n", -1)) + 1
    return F.when(error.isNotNull(), F.format_string("%s: line %d column %d (char %d)", error["message"], line, column, error["at"]))
