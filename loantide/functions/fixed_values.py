"""Labels, markers, word lists and constants that results must carry unchanged."""

# ---- fixed values: days-past-due buckets (upper bound not included, label) ----
FLOW7_BUCKETS = [
    (1, "0.Trong hạn"),
    (31, "1.1-30 ngày"),
    (61, "2.31-60 ngày"),
    (91, "3.61-90 ngày"),
    (121, "4.91-120 ngày"),
    (151, "5.121-150 ngày"),
    (None, "6.151++"),
]
CHIP6_BUCKETS = [
    (1, "1.Trong hạn"),
    (31, "2.1-30"),
    (61, "3.31-60"),
    (91, "4.61-90"),
    (121, "5.91-120"),
    (None, "6.>120"),
]
DAILY2_BUCKETS = [(11, "0"), (None, "1")]
CLOSED_BUCKET = (-1, "-1. Đã đóng")

# ---- fixed values: movement between two snapshots ----
ROLLED = "Rolled"
STUCK = "Stuck"
CURED = "Cured"
CLOSED = "Closed"

# ---- fixed values: category and shop markers ----
TITLE_MARK = "Đăng ký"
CAR_TITLE = "Đăng ký Ô tô"
BIKE_TITLE = "Đăng ký xe máy"
CAR = "Ô tô"
BIKE = "Xe máy"
TRACKER = "Thiết bị định vị"
TRACKER_MARK = "vị"
HEAD_OFFICE = "Hội Sở"
BIKE_TITLE_CODE = "17"
CAR_TITLE_CODE = "15"
LIQUIDATION_EXCLUDED_CODES = ["17", "15", "22", "19"]
TEST_SHOP_MARKS = ["TEST", "HS"]
OVERDUE_CLOSE_SHOP_MARKS = ["DR", "TEST", "HS"]

# ---- fixed values: packages and papers ----
ORDINARY_LOAN = "Vay thường"
QUICK_LOAN = "Vay nhanh"
QUICK_MARK = "NHANH"
PAPER_OWNED = "KT1"
PAPER_RENTED = "KT3"

# ---- fixed values: contract status codes ----
INACTIVE_STATUSES = [22, 15, -1, 1, 140, 11]
LISTED_INACTIVE_STATUSES = [22, 15, -1, 1, 140]
VOID_STATUSES = [15, 22, 11]
BAD_DEBT_STATUSES = [77, 88, 99]
NEW_CONTRACT_STATUSES = [1, 14]
CLOSED_STATUS = 1
TOP_UP_STATUS = 14

# ---- fixed values: chip and alert flags ----
CHIP_INSTALLED = "install_chip"
CHIP_MISSING = "not_chip"
BORROWED_AFTER = "brr_from_11.06"
BORROWED_BEFORE = "brr_before_11.06"
CHIP_CUTOFF = "2020-06-10"
RESPONDED = "responsed"
NO_RESPONSE = "no_response"
LOST_SIGNAL = "Chip bị mất tín hiệu"

# ---- fixed values: month codes ----
NEVER_WRITTEN_OFF = 9999999
PERFORMING_DPD = 11

# ---- fixed values: cash count check ----
CASH_TOLERANCE = 10000
CASH_SURPLUS = "dương quỹ"
CASH_SHORTAGE = "âm quỹ"
OK = "ok"
OVER_CASH_LIMIT = "Vượt hạn mức dư quỹ"
REASON_MISSING = "Không có lý do"
REASON_UNCLEAR = "Lý do lệch không rõ ràng"
REASON_UNKNOWN = "Lệch không rõ nguyên nhân"
REASON_MIN_WORDS = 3
REASON_MAX_WORDS = 30
UNCLEAR_WORDS = ["nhầm", "sai", "quên", "mượn", "thối", "nhập", "mất", "trộm", "sự cố", "lỗi"]
UNKNOWN_WORDS = ["nguyên nhân", "không rõ", "k rõ", "tìm ra", "không tìm", "chưa tìm", "chưa rõ"]
TREASURY_COLUMNS = [
    "ext_date", "last_count_time", "shop", "pos_cash_amt", "actual_count_amt", "diff", "diff_reason",
    "diff_type", "limit_amt", "reason_length", "limit_check", "diff_reason_check", "Người check",
    "Loại lệch quỹ", "Trạng thái check", "Kết quả",
]
LIMIT_COLUMNS = [
    "shopcode", "shopname", "customerid", "customername", "pawnid", "contractcode", "fromdate",
    "checker", "Loại hình sở hữu",
]

# ---- fixed values: fraud rules ----
DISBURSEMENT = "Cho vay"
BEFORE_FIRST_COUNT = "HĐ đóng/mở trước khi kiểm kê lần đầu"
AFTER_LAST_COUNT = "HĐ đóng/mở sau khi kiểm kê lần cuối"
NEAR_DAY_START = "HĐ mở/đóng đầu ngày"
NEAR_DAY_END = "HĐ mở/đóng cuối ngày"
OTHER_TIME = "Khác"
OPENED_TOO_FAST = "HĐ mở trong thời gian ngắn bất thường"
OPENED_TOO_SLOW = "HĐ mở trong thời gian dài bất thường"
CLOSED_EARLY = "HĐ đóng trong vòng 5 ngày kể từ ngày mở"
PAID_LATE = "HĐ thanh toán khi quá hạn trên 5 ngày"
FRAUD = "Gian lận"
COMPLIANCE = "Tuân thủ"
CAR_TITLE_REVIEW = "Hậu kiểm thẩm định ĐKOT"
NEW_CUSTOMER = "Khách mới"
RETURNING_CUSTOMER = "Khách cũ"
CHECKING_COLUMNS = [
    "year_month", "extrac_date", "shopname", "shopcode", "cusname", "codeno", "cate", "reason_check", "risk_type",
]

# ---- fixed values: loan size and term labels (upper bound included, label) ----
BIKE_TITLE_SIZES = [
    (3_000_000, "0. <=3tr"),
    (10_000_000, "1. 3-10tr"),
    (15_000_000, "2. 10-15tr"),
    (25_000_000, "3. 15-25tr"),
    (None, "4. >25tr"),
]
CAR_TITLE_SIZE_LABELS = {
    "to_50": "0. <=50tr",
    "to_100": "1. 50-100tr",
    "to_200": "2. 100-200tr",
    "to_300": "3. 200-300tr",
    "over_200": "4. >200tr",
    "over_300": "4. >300tr",
}
TERM_RANGES = [
    (30, "1. Kỳ hạn 1 tháng"),
    (90, "2. Kỳ hạn 3 tháng"),
    (180, "3. Kỳ hạn 6 tháng"),
    (270, "4. Kỳ hạn 9 tháng"),
    (360, "5. Kỳ hạn 12 tháng"),
    (None, "6. >12 tháng"),
]
FIRST_LOAN = "KH mới vay lần đầu"
BAD_DEBT = "KH đang nợ xấu"
TOP_UP = "7.Vay thêm"
ROLLOVER = "0.Đáo hạn"
REOPEN_AFTER = [
    (30, "1.Mở lại từ 1-30 ngày"),
    (60, "2.Mở lại từ 31-60 ngày"),
    (90, "3.Mở lại từ 61-90 ngày"),
    (180, "4.Mở lại từ 91-180 ngày"),
    (None, "5.Mở lại từ 181 ngày"),
]

# ---- fixed values: score-card fields, open bin ends and imputation ----
CATEGORICAL_FIELDS = ["papertype", "open_type", "cus_type", "package_time_range"]
GLOBAL_NUMERIC_FIELDS = [
    "cus_score", "num_created_pawn", "ols_pred_score", "open_hour_extracted", "average_nums_checked_pawn",
]
CATEGORY_NUMERIC_FIELDS = [
    "first_upload_to_open", "last_upload_to_open", "ltv_index", "nums_image", "package_money_range",
    "processing_minute",
]
OPEN_BIN_ENDS = {
    "cus_score": (None, 1000.0),
    "ols_pred_score": (-1000.0, None),
    "average_nums_checked_pawn": (0.0, 10.0),
    "ltv_index": (0.0, 2.0),
    "nums_image": (0.0, 999.0),
    "package_money_range": (0.0, 9999.0),
    "first_upload_to_open": (-99999.0, 99999.0),
    "last_upload_to_open": (-99999.0, 99999.0),
    "processing_minute": (-99999.0, 99999.0),
}
DEFAULT_PREDICTED_SCORE = 250.0
ALL_CATEGORIES = "All"
AUDIT_SAMPLE_SIZE = 40
AUDIT_TITLE_SHARE = 0.65
AUDIT_OTHER_SHARE = 0.35

# ---- fixed values: reminders ----
NOT_STARTED_MARK = "Chưa"
IN_PROGRESS_MARK = "Đang"
RISK_RECOMMENDATION = "KHUYẾN NGHỊ QTRR"
AUDIT_RECOMMENDATION = "KHUYẾN NGHỊ KTNB"
AUDIT_ISSUE = "SỰ VỤ"
MAIL_SUBJECT = "[CẢNH BÁO NỘI BỘ] CẬP NHẬT TIẾN ĐỘ THỰC HIỆN %s TẠI %s"
MAIL_GREETING = "Dear %s,"
MAIL_HEADLINES = {
    1: "%s số %s%s đã %d ngày Chưa chốt kế hoạch thực hiện",
    2: "%s số %s%s đã %d ngày Chưa có cập nhật mới về tiến độ thực hiện",
    3: "%s số %s%s đã quá Dealine cam kết hoàn thành %d ngày.",
    4: "%s số %s%s  Đang thực hiện còn %d ngày nữa sẽ đến Deadline cam kết.",
}
MAIL_REQUESTS = {
    1: "Bạn cần liên hệ với đại diện %s thực hiện Chốt kế hoạch sớm nhất có thể",
    2: "Bạn cần liên hệ với %s cập nhật tiến độ thực hiện mới nhất của khuyến nghị này.",
    3: "Bạn cần liên hệ với %s cập nhật lại tiến độ thực hiện mới nhất của khuyến nghị này.",
    4: "Bạn cần liên hệ với %s cập nhật lại tiến độ thực hiện mới nhất của khuyến nghị này.",
}
MAIL_DETAIL_TITLE = "Chi tiết Khuyến nghị"
MAIL_LINK_TITLE = "Truy cập Link Quản lý Khuyến nghị/Sự vụ sau để cập nhật: "
MAIL_RULER = "-------------"
MAIL_CLOSING = "Trân trọng"
