"""The sample run: sales at a steady pace, a few of them odd, and the tables around them."""

import json
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

FIRST_SALE = datetime(2022, 6, 9, 14, 2)
SALES, SECONDS_APART, SALES_PER_FILE = 12, 25, 2

# Customers as the stream brings them: names, state, its abbreviation.
CUSTOMERS = {21: ("Noor", "Haddad", 9, "NJ"), 22: ("Elif", "Stern", 14, "KS"), 23: ("Jun", "Park", 27, "NV")}
STATES = {9: ("New Jersey", "NJ"), 14: ("Kansas", "KS"), 27: ("Nevada", "NV"), 30: ("Ohio", "OH")}
VENDORS = {31: ("Lake Kiosk", "0700-1"), 32: ("Night Bus", "0700-2"), 33: ("Seed Shop", "0700-3")}
DAY = "2022-06-08"
UNKNOWN_CUSTOMER, UNKNOWN_VENDOR = 777, 888

# What is odd about a sale, by its number; all others are sound.
ODD_SALES = {
    2: {"vendor": UNKNOWN_VENDOR},
    4: {"state": "MISSING"},
    7: {"card": "Cheque"},
    9: {"customer": UNKNOWN_CUSTOMER},
    11: {"id": "sale-05"},  # an id that came before
}


def _sale(number):
    """(id, customer, vendor, state, time, card) of a sale."""
    sale = {
        "id": f"sale-{number:02d}",
        "customer": list(CUSTOMERS)[number % 3],
        "vendor": list(VENDORS)[number % 2],
        "state": ("CREATED", "SWIPED", "AUTHORIZED")[number % 3],
        "time": str(FIRST_SALE + timedelta(seconds=SECONDS_APART * number)),
        "card": ("Debit", "Credit")[number % 2],
    }
    return tuple((sale | ODD_SALES.get(number, {})).values())


ALL_ROWS = [_sale(number) for number in range(SALES)]
TRANSACTION_FILES = [ALL_ROWS[i : i + SALES_PER_FILE] for i in range(0, SALES, SALES_PER_FILE)]
# The third sale is in the first minute but in the second file, so a stream counts that minute twice.
BUSY_MINUTE, BUSY_COUNTS, LAST_MINUTE = "2022-06-09 14:02:00", [2, 3], "2022-06-09 14:06:00"


def _lines(rows):
    texts = [json.dumps(row) for row in rows]
    return [f"{texts[0]},", *texts[1:]]


CUSTOMER_LINES = _lines(
    {"customer_id": k, "state_id": state, "first_name": first, "last_name": last, "update_timestamp": DAY}
    for k, (first, last, state, _) in CUSTOMERS.items()
)
VENDOR_LINES = [
    json.dumps({"vendor_id": k, "vendor_name": name, "phone_number": phone, "update_timestamp": DAY})
    for k, (name, phone) in VENDORS.items()
]
STATIC_CUSTOMER_LINES = _lines(
    {
        "customer_id": k,
        "first_name": CUSTOMERS[k][0],
        "last_name": CUSTOMERS[k][1],
        "state_name": "Iowa",
        "state_abbreviation": "IA",
        "update_timestamp": DAY,
    }
    for k in CUSTOMERS
)
STATE_LINES = [
    *_lines({"state_id": k, "state_name": name, "state_abbreviation": short} for k, (name, short) in STATES.items()),
    "",
]


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def transaction_line(row):
    key, customer, vendor, state, when, card = row
    return json.dumps(
        {
            "transaction_id": key,
            "customer_id": customer,
            "vendor_id": vendor,
            "event_state": state,
            "event_timestamp": when,
            "price": f"{len(when) + customer / 4}",
            "card_type": card,
        }
    )


def write_lines(path, lines):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return path


def write_in_order(directory, files, pause=0.02):
    """Files whose modification times follow their order, so that a stream reads them in it."""
    import os

    for i, lines in enumerate(files):
        path = write_lines(Path(directory) / f"part-{i}.json", lines)
        os.utime(path, (1_600_000_000 + i * 10, 1_600_000_000 + i * 10))


INVALID_IDS = sorted(r[0] for r in ALL_ROWS if r[3] == "MISSING" or r[5] == "Cheque")
VALID_IDS = sorted(r[0] for r in ALL_ROWS if r[0] not in INVALID_IDS)
WINDOWS = dict(Counter(r[4][:-2] + "00" for r in ALL_ROWS))
