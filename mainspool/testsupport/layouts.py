"""Layouts and catalog of the test inputs. Keys are wide enough for tables of any size."""

from __future__ import annotations

from mainspool.layout import Layout
from mainspool.operators.route import Catalog

ACCOUNT_TEXT = """
       01  ACCOUNT.
           05 ACCT-KEY PIC 9(12).
           05 ORDERS-HELD PIC 9(4) COMP.
           05 HOLDER.
              10 HOLDER-NAME PIC X(24).
              10 NATION-CODE PIC X(4).
              10 SEGMENT PIC X(14).
           05 BOOK.
              10 PLACED OCCURS 0 TO 6 DEPENDING ON ORDERS-HELD.
                 15 PRICE PIC S9(13)V99 COMP-3.
                 15 ORDER-KEY PIC 9(12).
                 15 ORDER-DAY PIC X(10).
                 15 DAY-PARTS REDEFINES ORDER-DAY.
                    20 DAY-YEAR PIC X(4).
                    20 FILLER PIC X.
                    20 DAY-MONTH PIC XX.
                    20 FILLER PIC X.
                    20 DAY-OF-MONTH PIC XX.
                 15 PRIORITY PIC X(15).
"""

SALES_TEXT = """
           03 LINE-ID.
              05 ORDER-REF PIC X(12).
              05 LINE-POS PIC 9(4).
           03 SUPPLIER-NO PIC S9(9) COMP-3.
           03 PART-NO PIC S9(9) COMP-3.
           03 SHIPPED-ON PIC S9(9) COMP-3.
           03 NET-PRICE PIC S9(9)V99 COMP-3.
           03 UNITS PIC S9(9) COMP-3.
           03 TAX-GAP PIC S9(3)V99.
"""

SUPPLIER_TEXT = """
           03 VENDOR.
              10 VENDOR-NAME PIC X(30).
              10 FILLER PIC X(2).
              10 VENDOR-NO PIC S9(9) COMP.
              10 BALANCE-GAP PIC S9(13)V99 COMP.
              10 NATION-GAP PIC S9(4) COMP.
              10 FILLER PIC X.
              10 IN-CREDIT PIC X.
"""

VIEWS_TEXT = """
       01  KNOWN.
           05 VENDOR-NAME PIC X(30).
           05 FILLER PIC X(2).
           05 VENDOR-NO PIC S9(9) COMP.
           05 BALANCE-GAP PIC S9(13)V99 COMP.
           05 NATION-GAP PIC S9(4) COMP.
           05 FILLER PIC X.
           05 IN-CREDIT PIC X.
       01  SEEN.
           05 SEEN-FRONT PIC X(32).
           05 SEEN-NO PIC 9(9) COMP.
           05 SEEN-REST PIC X(12).
"""

IDENT_TEXT = """
           05 KIND-CODE PIC X(2).
"""

MIXED_BODIES = {
    "customer": """
           05 CUST-KEY PIC 9(12).
           05 CUST-NAME PIC X(20).
           05 CUST-BALANCE PIC S9(9)V99 COMP-3.
""",
    "order": """
           05 ORDER-KEY PIC 9(12).
           05 ORDER-STATUS PIC X.
           05 ORDER-PRICE PIC S9(9)V99 COMP-3.
           05 ORDER-PRIORITY PIC X(15).
""",
    "part": """
           05 PART-KEY PIC 9(12).
           05 PART-BRAND PIC X(10).
           05 PART-SIZE PIC 9(4) COMP.
""",
}

CATALOG_SPEC = {
    "header_layout": "ident",
    "records": [
        {
            "record": "customer",
            "copy_layout": "customer",
            "include_records": [{"name": "customer", "entries": {"KIND-CODE": "10"}}],
        },
        {
            "record": "order",
            "copy_layout": "order",
            "include_records": [
                {"name": "open", "entries": {"KIND-CODE": "20", "ORDER-STATUS": "o"}},
                {"name": "other", "entries": {"KIND-CODE": "20"}},
            ],
            "exclude_records": [{"name": "low", "entries": {"ORDER-PRIORITY": "5-LOW"}}],
        },
        {
            "record": "part",
            "copy_layout": "part",
            "include_records": [{"name": "part", "entries": {"KIND-CODE": "30"}}],
            "exclude_records": [{"name": "brand", "entries": {"KIND-CODE": "30", "PART-BRAND": "BRAND#13"}}],
        },
    ],
}

HEADER_LEN = 40
HEADER_TEXT = """
           03 ORDER-KEY PIC 9(12).
           03 ORDER-STATUS PIC X.
           03 HOLD-FLAG PIC X.
           03 BLOCK-NO PIC 9(6).
           03 ORDER-PRIORITY PIC X(20).
"""

PREFIX_TEXT = """
           03 LINE-TAG PIC X(2).
           03 LINE-BYTES PIC 9(4) COMP.
"""

LINE_TEXT = """
           03 LINE-NO PIC 9(4).
           03 PART-KEY PIC 9(12).
           03 SUPP-KEY PIC 9(12).
           03 QUANTITY PIC S9(9) COMP-3.
           03 PRICE PIC S9(13)V99 COMP-3.
"""

OVERLAID_ORDER = MIXED_BODIES["order"] + """
           05 PRIORITY-PARTS REDEFINES ORDER-PRIORITY.
              10 PRIORITY-RANK PIC X.
              10 FILLER PIC X(14).
           05 ORDER-END PIC X.
"""

REPEATED_TEXT = """
           03 FRONT.
              10 NAME PIC X(30).
              10 NAME PIC X(2).
              10 FILE PIC S9(9) COMP.
           03 BACK.
              10 FILE PIC S9(13)V99 COMP.
              10 NAME PIC S9(4) COMP.
              10 REC-NO PIC X.
              10 FILE-2 PIC X.
"""

UNSET_TEXT = """
           05 ORDER-KEY PIC 9(12).
           05 LINE-POS PIC 9(4).
           05 LINE-SIGNED PIC S9(4).
"""

BASKET_TEXT = """
           05 OWNER PIC 9(12).
           05 ORDERS-HELD PIC 9.
           05 PLACED OCCURS 0 TO 3 DEPENDING ON ORDERS-HELD.
              10 ORDER-KEY PIC 9(12).
              10 LINES.
                 15 LINES-HELD PIC 9(4) COMP.
              10 LINE OCCURS 0 TO 4 DEPENDING ON LINES-HELD.
                 15 LINE-NO PIC 9(4).
                 15 PRICE PIC S9(13)V99 COMP-3.
                 15 NOTES-HELD PIC 9.
                 15 NOTE PIC X(3) OCCURS 0 TO 2 DEPENDING ON NOTES-HELD.
                 15 PART-KEY PIC 9(12).
              10 STATUS PIC X.
           05 LAST-MARK PIC X(3).
"""

FIGURES_TEXT = """
           05 CUST-KEY PIC 9(12).
           05 PRINTED PIC Z,ZZZ,ZZ9.99CR.
           05 SIGNED PIC +,+++,++9.99.
           05 EXACT COMP-2.
           05 SHORT USAGE IS COMP-1.
           05 NATION PIC ZZZ.
"""


ACCOUNT = Layout.parse(ACCOUNT_TEXT)
SALES = Layout.parse(SALES_TEXT)
SUPPLIER = Layout.parse(SUPPLIER_TEXT)
SUPPLIER_VIEWS = Layout.parse(VIEWS_TEXT)
HEADER = Layout.parse(HEADER_TEXT)
PREFIX = Layout.parse(PREFIX_TEXT)
LINE = Layout.parse(LINE_TEXT)
REPEATED = Layout.parse(REPEATED_TEXT)
UNSET = Layout.parse(UNSET_TEXT)
FIGURES = Layout.parse(FIGURES_TEXT)
BASKET = Layout.parse(BASKET_TEXT)


def mixed_catalog(excludes: bool = True, tables: str | None = None, overlay: bool = False, **extra) -> Catalog:
    """The mixed file's catalog; ``tables`` starts the names of its tables, ``overlay`` gives
    orders an overlay and an end mark, ``extra`` adds top-level entries."""
    spec = {**CATALOG_SPEC, **extra}
    if tables is not None:
        spec["records"] = [{**r, "hive_table": f"{tables}_{r['record']}"} for r in spec["records"]]
    if not excludes:
        spec["records"] = [{k: v for k, v in r.items() if k != "exclude_records"} for r in spec["records"]]
    bodies = {**MIXED_BODIES, "order": OVERLAID_ORDER} if overlay else MIXED_BODIES
    return Catalog.from_json(spec, {"ident": IDENT_TEXT, **bodies})
