"""Dates and literal lookup tables shared by the Spark queries and their SQL twins."""

from __future__ import annotations

import datetime as dt

OPENING = "2000-05-31"
CLOSING = "2000-06-29"
AS_OF = "2000-06-29"
ALERT_AS_OF = "2000-06-15"
CHIP_CUTOFF = "1999-12-31"

# The events of the test data are moved so that they end shortly after ALERT_AS_OF.
EVENT_SHIFT_DAYS = (dt.date(2024, 1, 1) - dt.date(2000, 5, 22)).days

# Range of days the daily rules are run over.
RULES_FROM = "2000-05-22"
RULES_TO = "2000-06-20"

PRIORITY_CATEGORY = [
    ("1-URGENT", "C17", "Đăng ký xe máy"),
    ("2-HIGH", "C15", "Đăng ký Ô tô"),
    ("3-MEDIUM", "C22", "Thiết bị định vị"),
    ("4-NOT SPECIFIED", "C01", "Xe máy"),
    ("5-LOW", "C02", "Điện thoại"),
]

ALERT_CONTENT = [
    ("error", "Chip bị mất tín hiệu"),
    ("purchase", "Chip bị tháo"),
    ("signup", "Xe ra khỏi vùng"),
]

CASH_NOTES = [
    "Nhập nhầm, trả lại sau!",
    "Chưa rõ nguyên nhân???",
    "lệch",
    "khách trả thiếu tiền - mượn (2 ngày)",
    "đã  kiểm tra đủ tiền",
]

THRESHOLDS = [
    ("Đăng ký xe máy", 12.0, 150.0),
    ("Điện thoại", 20.0, 130.0),
    ("Xe máy", 10.0, 100.0),
]

WRITE_OFF_PERIODS = [200001, 200006, 200007, 200101]

FOCUS_PACKAGES = [
    ("Vay nhanh 1", "NHANH01", "2000-01-01", "2000-12-31", "Active", "High"),
    ("Vay nhanh 0", "NHANH00", "1999-01-01", "1999-12-31", "Active", "Low"),
    ("Gói 02", "G02", "2000-06-01", "2000-06-30", "Active", "Medium"),
]

CATEGORICAL_CARD = [
    ("All", "papertype", "KT1", 3.0),
    ("All", "papertype", "KT3", 7.5),
    ("All", "cus_type", "Khách mới", 6.0),
    ("All", "cus_type", "Khách cũ", 2.0),
    ("All", "open_type", "KH mới vay lần đầu", 8.0),
    ("All", "open_type", "KH đang nợ xấu", 10.0),
    ("All", "open_type", "7.Vay thêm", 5.0),
    ("All", "open_type", "0.Đáo hạn", 1.0),
    ("All", "open_type", "1.Mở lại từ 1-30 ngày", 2.5),
    ("All", "open_type", "5.Mở lại từ 181 ngày", 4.0),
    ("Đăng ký xe máy", "package_time_range", "1. Kỳ hạn 1 tháng", 1.0),
    ("Đăng ký xe máy", "package_time_range", "3. Kỳ hạn 6 tháng", 4.0),
    ("Điện thoại", "package_time_range", "1. Kỳ hạn 1 tháng", 2.0),
    ("Điện thoại", "package_time_range", "5. Kỳ hạn 12 tháng", 6.0),
]

_CARD_CATEGORIES = ["Đăng ký xe máy", "Xe máy", "Điện thoại", "Thiết bị định vị"]


def _bins(category, field, edges, scores, package=None):
    return [(category, field, lo, hi, package, s) for lo, hi, s in zip(edges[:-1], edges[1:], scores)]


NUMERIC_CARD = (
    _bins("All", "cus_score", [0.0, 300.0, 700.0, None], [9.0, 5.0, 1.0])
    + _bins("All", "num_created_pawn", [0.0, 2.0, 5.0, 100000.0], [1.0, 3.0, 6.0])
    + _bins("All", "ols_pred_score", [None, 200.0, 300.0, 2000.0], [2.0, 4.0, 8.0])
    + _bins("All", "open_hour_extracted", [0.0, 9.0, 18.0, 24.0], [5.0, 1.0, 7.0])
    + _bins("All", "average_nums_checked_pawn", [None, 0.05, 0.5, None], [6.0, 3.0, 1.0])
    + [row for c in _CARD_CATEGORIES for row in (
        _bins(c, "first_upload_to_open", [None, -50.0, 0.0, None], [4.0, 2.0, 6.0])
        + _bins(c, "last_upload_to_open", [None, 0.0, 60.0, None], [1.5, 2.5, 5.5])
        + _bins(c, "ltv_index", [None, 0.6, 0.9, None], [1.0, 3.0, 9.0])
        + _bins(c, "nums_image", [None, 3.0, 6.0, None], [7.0, 3.0, 1.0])
        + _bins(c, "package_money_range", [None, 10.0, 25.0, None], [2.0, 4.0, 6.0])
        + _bins(c, "processing_minute", [None, 30.0, 100.0, None], [6.0, 2.0, 3.0], "Vay nhanh")
        + _bins(c, "processing_minute", [None, 45.0, 120.0, None], [5.0, 1.0, 4.0], None)
    )]
)

CONTACTS = [(f"src{i}", f"owner{i}@example.org") for i in range(0, 18)]
ESCALATE_TO = ["lead@example.org", "audit@example.org"]
ACTION_LINK = "https://example.org/actions"


def sql_values(rows: list[tuple]) -> str:
    """Rows as the body of a SQL VALUES list."""

    def cell(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
