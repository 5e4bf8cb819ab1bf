"""Table schemas, label vocabularies and the topic/keyword dimension."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _I = T.StringType(), T.IntegerType()

# Stored labels are 64-bit, as dataframe libraries write them; files with 32-bit labels widen on read.
RAW_SCHEMA = _struct(id=_S, text=_S, topic=_S, keyword=_S, url=_S, label=T.LongType())
PARTITION_SCHEMA = _struct(platform=_S, crawl_date=T.DateType())
PROCESSED_SCHEMA = T.StructType(RAW_SCHEMA.fields + PARTITION_SCHEMA.fields + _struct(split_set=_S).fields)
INGEST_CSV_SCHEMA = _struct(text=_S, topic=_S, keyword=_S, post_url=_S, source=_S, label=_I)
CRAWL_CSV_SCHEMA = _struct(text=_S, topic=_S, keyword=_S, post_url=_S)

#: In a kept table, how many comments a row stands for.
KEPT_ROWS = "kept_rows"

# ---- fixed values -------------------------------------------------------------------------
PLATFORMS = ("threads", "tiktok")

UNLABELLED = -1
CLASSES = (0, 1, 2)

# label, display name, upper-case name, lower-case name, registry name
LABEL_ROWS = (
    (-1, "chưa gán nhãn", None, None, None),
    (0, "bình thường", "CLEAN", "clean", "normal"),
    (1, "offensive", "OFFENSIVE", "offensive", "offensive"),
    (2, "hate speech", "HATE", "hate", "hate_speech"),
)
UNKNOWN_LABEL_NAME = "không xác định"

TOPIC_KEYWORDS = {
    "the_thao": ("Bóng đá", "Thể thao", "Liên minh huyền thoại", "Liên quân mobile", "Thể hình",
                 "Bóng chuyền", "Cầu lông", "Chạy bộ", "Bóng rổ", "Tin thể thao"),
    "lam_dep": ("Trang điểm", "Chăm sóc da", "Làm đẹp", "Đánh giá mỹ phẩm", "Làm tóc",
                "Mỹ phẩm thuần chay", "Mẹo làm đẹp", "Trị mụn", "Son môi", "Móng tay đẹp"),
    "am_thuc": ("Ẩm thực", "Nấu ăn", "Đánh giá món ăn", "Quay cảnh ăn uống", "Món ngon mỗi ngày",
                "Công thức nấu ăn", "Ăn vặt", "Địa điểm ăn uống", "Học làm bánh", "Ẩm thực đường phố"),
    "giai_tri": ("Xu hướng", "Hài hước", "Thịnh hành", "Nhạc hay", "Đánh giá phim",
                 "Phim hay", "Chương trình giải trí", "Ảnh chế", "Nhạc thư giãn", "Tin giải trí"),
    "giao_duc": ("Học tập", "Sách hay", "Tiếng Anh", "Khoa học", "Du học",
                 "Phát triển bản thân", "Mẹo học tập", "Lịch sử", "Tin học văn phòng", "Kỹ năng sống"),
    "chinh_tri": ("Tin tức", "Xã hội", "Thời sự", "Tin nóng dư luận", "Bản tin 24 giờ",
                  "Tin nóng", "Sự kiện", "Thế giới", "Phóng sự", "Điểm tin"),
    "cong_nghe": ("Công nghệ", "Đánh giá công nghệ", "Thủ thuật", "Trí tuệ nhân tạo", "Điện thoại mới",
                  "Đập hộp", "Máy tính chơi game", "Ứng dụng hay", "Gạt công nghệ", "Nhà thông minh"),
    "kinh_doanh": ("Kinh doanh", "Khởi nghiệp", "Tài chính", "Chứng khoán", "Kiếm tiền trực tuyến",
                   "Đầu tư", "Quản lý tài chính", "Bất động sản", "Bài học kinh doanh", "Tiếp thị"),
    "thoi_trang": ("Thời trang", "Trang phục", "Phối đồ", "Thời trang nam", "Thời trang nữ",
                   "Xu hướng thời trang", "Phong cách", "Thương hiệu nội địa", "Phụ kiện thời trang",
                   "Mua sắm quần áo"),
    "du_lich": ("Du lịch", "Khám phá", "Check-in Việt Nam", "Phượt", "Đánh giá du lịch",
                "Kinh nghiệm du lịch", "Du lịch tự túc", "Khách sạn đẹp", "Ẩm thực vùng miền",
                "Cẩm nang chuyến đi"),
}
# ---- end of fixed values ------------------------------------------------------------------


def _constant_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small fixed table as part of the plan itself (an Arrow table becomes a local relation)."""
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.fieldNames())}
    return spark.createDataFrame(pa.table(columns), schema)


def label_dim(spark: SparkSession) -> DataFrame:
    """One row per known label with its name in the four vocabularies in use."""
    schema = _struct(label=_I, label_name=_S, upper_name=_S, lower_name=_S, registry_name=_S)
    return _constant_rows(spark, LABEL_ROWS, schema)


def topic_keyword_dim(spark: SparkSession) -> DataFrame:
    """The (topic, keyword) pairs a crawl is driven by."""
    pairs = [(topic, kw) for topic, kws in TOPIC_KEYWORDS.items() for kw in kws]
    return _constant_rows(spark, pairs, _struct(topic=_S, keyword=_S))


def model_registry(spark: SparkSession, rows) -> DataFrame:
    """Registry entries ``(model_id, model_display_name, model_type, version)`` as a table."""
    return _constant_rows(
        spark, rows, _struct(model_id=_S, model_display_name=_S, model_type=_S, version=_S)
    )
