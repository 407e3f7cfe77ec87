from vantage.functions.expressions import (  # noqa: F401
    HEAVY_VEHICLE_KEYWORDS,
    MASK_PADDING,
    TWO_WHEELER_KEYWORDS,
    bbox_area,
    clamp_bbox_area,
    cosine_of_units,
    entropy_term,
    file_stem,
    fix_image_area,
    json_list_text,
    fallback_category_name,
    keyword_flag,
    l2_normalize,
    mask_rect,
    safe_ratio,
    to_integer,
    vector_norm,
)
