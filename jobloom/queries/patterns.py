"""Patterns of the SQL twins, written out by themselves so that a wrong pattern of the library shows."""

# White space, an experience, a salary statement with its period.
SPACE = (
    r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
EXPERIENCE = r"[0-9]+-[0-9]+|[0-9]+" + SPACE + r"*to" + SPACE + r"*[0-9]+|[0-9]+\+|[0-9]+"
SALARY = (
    r"(\$[0-9,]+(?:\.[0-9][0-9]?)?(?:" + SPACE + r"*(?:-|–)" + SPACE + r"*\$[0-9,]+(?:\.[0-9][0-9]?)?)?)" + SPACE
    + r"*(a|per)" + SPACE + r"*(day|year|hour|week)"
)
