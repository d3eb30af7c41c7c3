"""Code lists of the domain.

Everything in this file is a fixed value: results depend on these exact
names, so they are written out plainly and in one place.
"""

# Semester code -> label.
SEMESTER_NAMES = {"1": "Spring", "2": "Summer", "3": "Fall"}

# College code -> label.
COLLEGE_NAMES = {
    "MD": "Medicine",
    "MD_PROF": "Medicine - Professional",
    "NU": "Nursing",
    "EN": "Engineering",
    "BA": "Business",
    "ED": "Education",
    "LA": "Liberal Arts",
    "SC": "Science",
    "AG": "Agriculture",
    "AR": "Architecture",
    "GB": "Bush School of Government and Public Service",
    "GE": "Geosciences",
    "GV": "Galveston",
    "QT": "Qatar",
    "VM": "Veterinary Medicine",
}

# College codes of the work grid ("PH" is listed twice on purpose).
COLLEGE_CODES = [
    "AG", "AR", "BA", "ED", "EN", "GB", "GE", "LA", "MD", "NU", "PH", "SC",
    "VM", "GV", "QT", "MD_PROF", "DN", "LW", "PU", "UN", "PH",
]

# Reporting groups of colleges.
COLLEGE_GROUPS = {
    "STEM": ["EN", "SC", "GE", "AG"],
    "HEALTH": ["MD", "MD_PROF", "NU", "PH", "DN", "PU", "VM"],
    "BUSINESS": ["BA"],
    "LIBERAL_ARTS": ["LA"],
}

# Report types and semesters of the work grid.
REPORT_TYPES = ["grd", "gpad", "gpac"]
SEMESTERS = [1, 2, 3]
FIRST_YEAR = 2017

# Fixed value: a report file below this size counts as missing.
MIN_FILE_BYTES = 2048

# Column names of an extracted section grid, left to right.
GRID_COLUMNS = [
    "Section", "A", "B", "C", "D", "F", "Total A-F", "GPA",
    "I", "S", "U", "Q", "X", "Total", "Instructor", " ",
]

# Text that marks a totals row of a section grid.
NOISE_KEYWORDS = ["%", "TOTAL"]

# Text in `Section` that marks a totals or header row.
HEADER_WORDS = ["total", "course total", "page", "instructor"]

# Renamed subjects, plan subject -> historical subjects.
SUBJECT_ALIASES = {"PBSI": ["PSYC"]}

# Plan row types that carry one unit of credit.
COURSE, HEADER, OPTION = "course", "choice_header", "choice_option"
BLOCK, SUBTOTAL, TOTAL = "requirement_block", "term_subtotal", "plan_total"

UNKNOWN = "Unknown"
