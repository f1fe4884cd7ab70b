"""Sentences with numbers, as written and as spoken: nine categories of values, drawn by hashes of a seed and a row's key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import DIGITS, spoken
from .text import bound, digits_spelled, uniform, weighted

#: The categories with their shares.
SHARES = [("year", 0.12), ("date", 0.12), ("phone", 0.15), ("percentage", 0.12), ("price", 0.12), ("count", 0.15), ("simple", 0.12), ("plain_digits", 0.05), ("plain_single", 0.05)]
#: The days of a week.
DAYS = ["hai", "ba", "tư", "năm", "sáu", "bảy", "chủ nhật"]
#: The sentences of each category.
TEMPLATES = {
    "year": [
        "Năm {n} là một năm đầy những sự kiện đáng nhớ.",
        "Sự kiện lịch sử hào hùng đó diễn ra vào năm {n}.",
        "Đến năm {n}, công trình này dự kiến sẽ hoàn thành xuất sắc.",
        "Nhà thơ sinh năm {n} tại một làng quê nghèo miền Trung.",
        "Bộ phim truyền hình nổi tiếng được ra mắt công chúng lần đầu vào năm {n}.",
        "Kể từ năm {n}, doanh nghiệp đã liên tục phát triển bứt phá.",
        "Vào năm {n}, một phát minh khoa học vĩ đại đã thay đổi thế giới.",
        "Hiệp định song phương được chính thức ký kết vào năm {n}.",
        "Trường học của chúng tôi được khánh thành vào năm {n}.",
        "Bản báo cáo thống kê tình hình phát triển tính từ năm {n} trở đi.",
    ],
    "date": [
        "Hôm nay là thứ {thu}, ngày {ngay} tháng {thang}.",
        "Cuộc họp hội đồng quản trị sẽ diễn ra vào ngày {ngay} tháng {thang} năm {nam}.",
        "Lễ kỷ niệm truyền thống được long trọng tổ chức vào ngày {ngay} tháng {thang}.",
        "Gia đình chúng tôi sẽ đi du lịch từ ngày {ngay} tháng {thang} năm {nam}.",
        "Bản hợp đồng thương mại này có hiệu lực bắt đầu từ ngày {ngay} tháng {thang}.",
        "Quyết định chính thức được ban hành vào ngày {ngay} tháng {thang} năm {nam}.",
        "Sự kiện tri ân khách hàng sẽ bắt đầu lúc tám giờ sáng ngày {ngay} tháng {thang}.",
        "Tôi sinh ra vào một ngày mưa tầm tã, chính xác là ngày {ngay} tháng {thang} năm {nam}.",
        "Nhà trường sẽ tổ chức hội thao từ ngày {ngay} tháng {thang}.",
        "Hạn cuối để nộp hồ sơ đăng ký là ngày {ngay} tháng {thang} năm {nam}.",
    ],
    "phone": [
        "Mọi chi tiết thắc mắc xin vui lòng liên hệ số điện thoại {n}.",
        "Hãy gọi ngay cho tôi qua số hotline {n} khi bạn đến nơi.",
        "Số điện thoại hỗ trợ kỹ thuật trực tuyến là {n}.",
        "Vui lòng gửi tin nhắn xác nhận vào số thuê bao {n} để đăng ký.",
        "Số điện thoại di động cá nhân của cô ấy là {n}.",
        "Nếu có sự cố khẩn cấp, hãy gọi trực tiếp đến số {n}.",
        "Tổng đài tư vấn chăm sóc khách hàng miễn phí là {n}.",
        "Vui lòng ghi lại số điện thoại liên lạc của phòng ban chúng tôi: {n}.",
        "Bạn có thể nhắn tin Zalo qua số điện thoại di động {n}.",
        "Số hotline tiếp nhận phản ánh phản hồi từ người dân là {n}.",
    ],
    "percentage": [
        "Tỷ lệ tăng trưởng kinh tế năm nay đạt mức kỷ lục {n}.",
        "Khoảng {n} nhân viên bày tỏ sự đồng ý hoàn toàn với chính sách phúc lợi mới.",
        "Sản phẩm công nghệ cao được giảm giá sâu đến {n} trong dịp mua sắm cuối năm.",
        "Cơ hội thành công của dự án khởi nghiệp này được đánh giá lên tới {n}.",
        "Nước ngọt chiếm tỷ trọng khoảng {n} tổng lượng nước trên toàn thế giới.",
        "Tần suất xuất hiện lỗi hệ thống đã giảm xuống dưới {n} sau đợt cập nhật.",
        "Hơn {n} ý kiến khảo sát đánh giá dịch vụ đạt tiêu chuẩn chất lượng cao.",
        "Mức thuế VAT áp dụng cho mặt hàng này dự kiến sẽ giảm còn {n}.",
        "Chỉ số hài lòng của khách hàng trong quý này tăng vọt lên {n}.",
        "Hiệu suất hoạt động của máy nén khí đạt tối đa {n} công suất thiết kế.",
    ],
    "price": [
        "Giá vé xem phim định dạng 3D vào ngày thường là {n} đồng.",
        "Món ăn đặc sản này hiện có mức giá bán là {n} VNĐ tại cửa hàng.",
        "Họ đã đầu tư tổng số tiền lên đến {n} đồng cho chuyến phiêu lưu.",
        "Sản phẩm dưỡng da cao cấp này đang được bán công khai với giá {n}đ.",
        "Tổng quỹ quyên góp từ thiện nhận được số tiền ủng hộ là {n} đồng.",
        "Chi phí sửa chữa động cơ xe máy dự kiến tốn khoảng {n} đồng.",
        "Hóa đơn thanh toán tiền điện tháng này của nhà tôi lên tới {n} đồng.",
        "Bạn có thể sở hữu chiếc áo khoác thời trang này chỉ với giá {n} VNĐ.",
        "Gói dịch vụ internet tốc độ cao có cước phí thuê bao {n} đồng một tháng.",
        "Mức giá sàn cho mỗi cổ phiếu của tập đoàn được ấn định là {n} đồng.",
    ],
    "count": [
        "Có khoảng {n} người hâm mộ đã đổ về sân vận động để tham gia sự kiện.",
        "Nhà máy hiện đại đã hoàn thành sản xuất thành công {n} sản phẩm.",
        "Quãng đường di chuyển từ trung tâm đến ngoại ô dài khoảng {n} mét.",
        "Trong chiến dịch xanh, các tình nguyện viên đã trồng được {n} cây xanh.",
        "Khu đô thị mới được xây dựng quy mô có hơn {n} hộ gia đình sinh sống.",
        "Dự án đã ghi nhận tổng cộng {n} lượt tải ứng dụng trên toàn cầu.",
        "Thư viện trung tâm lưu trữ hơn {n} đầu sách quý hiếm thuộc nhiều lĩnh vực.",
        "Bức tường thành kiên cố có chiều dài đo được là {n} km.",
        "Nhiệt độ đo được ngoài trời trưa nay đã tăng cao đến {n} độ C.",
        "Công ty vừa tuyển dụng bổ sung thêm {n} nhân sự chất lượng cao.",
    ],
    "simple": [
        "Nhà tôi nằm ở số {n} đường Lê Lợi, quận một.",
        "Hiện tại có {n} chiếc xe ô tô đang đỗ hàng dọc bên lề đường.",
        "Cuốn sách hướng dẫn lập trình này bao gồm tổng cộng {n} trang viết.",
        "Lớp học tiếng Anh giao tiếp buổi tối hôm nay có sĩ số {n} học sinh.",
        "Bây giờ đã là {n} giờ rưỡi chiều rồi, chúng ta nên chuẩn bị đi thôi.",
        "Cửa hàng mở cửa phục vụ khách từ {n} giờ sáng mỗi ngày.",
        "Bài kiểm tra cuối kỳ của tôi đạt điểm số {n} trên thang điểm mười.",
        "Mục tiêu tiếp theo nằm ở dòng số {n} trong tài liệu tham khảo.",
        "Em bé đã tự đếm được từ một đến {n} mà không cần ai giúp đỡ.",
        "Căn hộ chung cư cao cấp của gia đình anh ấy ở tầng thứ {n}.",
        "Tọa độ địa lý của vị trí này được xác định chính xác là {n}.",
        "Hằng số vật lý đặc biệt này có giá trị đo đạc khoảng {n}.",
        "Kết quả đo sai lệch điện tử ghi nhận mức độ {n}.",
        "Chỉ số hiệu chuẩn của thiết bị hiển thị chính xác số {n}.",
        "Tỷ lệ sai số tuyệt đối được ước tính rơi vào khoảng {n}.",
    ],
    "plain_digits": ["{n}"],
    "plain_single": ["{n}"],
}


def draw(key: Column, what: str) -> Column:
    return uniform(F.lit(what), key)


def between(key: Column, what: str, low: int, high: int) -> Column:
    """A whole number from low to high."""
    return (F.floor(draw(key, what) * (high - low + 1)) + low).cast("long")


def digits(key: Column, what: str, n: Column | int) -> Column:
    """n digits; the seeds of the places are apart."""
    count = n if isinstance(n, Column) else F.lit(n)
    return F.array_join(F.transform(F.sequence(F.lit(1), count.cast("int")), lambda k: F.floor(uniform(F.lit(what), key, k) * 10).cast("string")), "")


def pair(written: Column, said: Column) -> Column:
    return F.struct(written.alias("written"), said.alias("said"))


def fraction(before: Column, after: Column, sign: Column) -> Column:
    """before,after and how it is said."""
    minus = F.when(sign, "-").otherwise("")
    return pair(F.concat(minus, before.cast("string"), F.lit(","), after), F.concat(F.when(sign, "âm ").otherwise(""), spoken(before), F.lit(" phẩy "), digits_spelled(after, DIGITS)))


def phone(key: Column) -> Column:
    """A number of ten digits that begins with 0, in one of three layouts."""
    layout = between(key, "layout", 0, 2)

    def made(d: Column) -> Column:
        number = F.concat(F.lit("0"), d)
        cut = lambda *at: F.concat_ws(" ", *[F.substring(number, a, n) for a, n in at])
        return pair(F.when(layout == 0, number).when(layout == 1, cut((1, 3), (4, 3), (7, 4))).otherwise(cut((1, 4), (5, 3), (8, 3))), digits_spelled(number, DIGITS))

    return bound(digits(key, "phone", 9), made)


def percentage(key: Column) -> Column:
    """Up to 99999 per cent, or in three of ten cases with up to three decimals."""
    part = bound(digits(key, "decimals", between(key, "places", 1, 3)), lambda after: fraction(between(key, "whole", 0, 9999), after, F.lit(False)))
    whole = between(key, "percent", 0, 99999)
    each = F.when(draw(key, "decimal") < 0.3, part).otherwise(pair(whole.cast("string"), spoken(whole)))
    return bound(each, lambda p: pair(F.concat(p["written"], F.lit("%")), F.concat(p["said"], F.lit(" phần trăm"))))


def whole_number(key: Column, what: str, low: int, high: int) -> Column:
    return bound(between(key, what, low, high), lambda n: pair(n.cast("string"), spoken(n)))


def scientific(key: Column) -> Column:
    """Two decimals and an exponent of ten, of a number from -100000 to 100000."""
    x = draw(key, "scientific") * 2e5 - 1e5

    def made(v: Column) -> Column:
        size = F.abs(v)
        exponent = F.when(size > 0, F.floor(F.log10(size))).otherwise(0).cast("long")
        base = F.format_string("%.2f", size / F.pow(F.lit(10.0), exponent.cast("double")))
        sign = v < 0
        written = F.concat(F.when(sign, "-").otherwise(""), F.replace(base, F.lit("."), F.lit(",")), F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
        said = F.concat(F.when(sign, "âm ").otherwise(""), spoken(F.substring_index(base, ".", 1).cast("long")), F.lit(" phẩy "), digits_spelled(F.substring_index(base, ".", -1), DIGITS), F.lit(" nhân mười mũ "), spoken(exponent))
        return pair(written, said)

    return bound(x, made)


def simple(key: Column) -> Column:
    """Small, signed, large and decimal numbers, fractions, and powers of ten."""
    u = draw(key, "kind")
    decimal = bound(digits(key, "fine", between(key, "fine places", 1, 3)), lambda after: fraction(between(key, "before", 0, 999_999), after, draw(key, "sign") < 0.3))
    top, bottom = between(key, "top", -100, 100), between(key, "bottom", 1, 100)
    ratio = pair(F.concat_ws("/", top.cast("string"), bottom.cast("string")), F.concat(spoken(top), F.lit(" phần "), spoken(bottom)))
    return (
        F.when(u < 0.15, whole_number(key, "small", -9, 9))
        .when(u < 0.35, whole_number(key, "signed", -999_999, 999_999))
        .when(u < 0.55, whole_number(key, "large", 1_000_000, 9_999_999_999))
        .when(u < 0.75, decimal)
        .when(u < 0.9, ratio)
        .otherwise(scientific(key))
    )


def singles(key: Column) -> Column:
    """Two to six digits one by one."""
    return bound(digits(key, "single", between(key, "singles", 2, 6)), lambda d: pair(F.array_join(F.split(d, ""), " "), digits_spelled(d, DIGITS)))


def category(key: Column) -> Column:
    return weighted(draw(key, "category"), SHARES)


def template(key: Column, kind: Column) -> Column:
    """One of the kind's sentences."""
    every = F.create_map(*[x for k, v in TEMPLATES.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))])
    return bound(F.element_at(every, kind), lambda t: F.get(t, F.floor(draw(key, "template") * F.size(t)).cast("int")))


def dated(key: Column, sentence: Column) -> Column:
    day = F.element_at(F.array(*[F.lit(x) for x in DAYS]), between(key, "day", 1, len(DAYS)).cast("int"))
    values = {"ngay": between(key, "of month", 1, 31), "thang": between(key, "month", 1, 12), "nam": between(key, "of year", 1, 9999)}
    written = said = F.replace(sentence, F.lit("{thu}"), day)
    for name, n in values.items():
        written = F.replace(written, F.lit("{" + name + "}"), n.cast("string"))
        said = F.replace(said, F.lit("{" + name + "}"), spoken(n))
    return pair(written, said)


def value(key: Column, kind: Column) -> Column:
    """The number of a category as (written, said)."""
    return (
        F.when(kind == "year", whole_number(key, "year", 1, 9999))
        .when(kind == "phone", phone(key))
        .when(kind == "percentage", percentage(key))
        .when(kind.isin("price", "count", "plain_digits"), whole_number(key, "amount", 1, 9_999_999_999))
        .when(kind == "simple", simple(key))
        .when(kind == "plain_single", singles(key))
    )


def sentence(key: Column) -> Column:
    """(category, written, said) of a row's key."""
    spelled_out = lambda t: F.replace(F.replace(t, F.lit("{n} VNĐ"), F.lit("{n} việt nam đồng")), F.lit("{n}đ"), F.lit("{n} đồng"))

    def filled(x: Column) -> Column:
        numbered = bound(value(key, x["kind"]), lambda v: pair(F.replace(x["t"], F.lit("{n}"), v["written"]), F.replace(F.when(x["kind"] == "price", spelled_out(x["t"])).otherwise(x["t"]), F.lit("{n}"), v["said"])))
        both = F.when(x["kind"] == "date", dated(key, x["t"])).otherwise(numbered)
        return bound(both, lambda p: F.struct(x["kind"].alias("category"), p["written"].alias("written"), p["said"].alias("said")))

    return bound(category(key), lambda kind: bound(F.struct(kind.alias("kind"), template(key, kind).alias("t")), filled))
