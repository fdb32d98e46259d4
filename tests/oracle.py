"""The order in plain Python, to hold the sorts against."""


def oracle_key(line: str):
    """Plain Python reference order: text by UTF-16 code units, number, line."""
    d = line.index(".")
    t = line[d + 1:]
    if t.startswith(" "):
        t = t[1:]
    return (t.encode("utf-16-be"), int(line[:d].strip(" \t\n\x0b\x0c\r\x00")), line)
