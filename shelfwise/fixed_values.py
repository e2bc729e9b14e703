"""Fixed values of the catalog rules: word lists, look-up tables, bands and patterns.

They have to equal the published rules for right results, so they stand here as plain text.
"""

# Brand words in the order they are tried.
BRAND_WORDS = {
    "iphone": "Apple",
    "apple": "Apple",
    "samsung": "Samsung",
    "xiaomi": "Xiaomi",
    "asus": "Asus",
    "bphone": "Bphone",
    "redmi": "Xiaomi",
    "infinix": "Infinix",
    "inoi": "Inoi",
    "itel": "Itel",
    "nokia": "Nokia",
    "sony": "Sony",
    "nothing": "Nothing",
    "nubia": "Nubia",
    "poco": "Xiaomi",
    "huawei": "Huawei",
    "vivo": "Vivo",
    "oppo": "OPPO",
    "honor": "Honor",
    "realme": "Realme",
    "tecno": "Tecno",
    "viettel": "Viettel",
    "vsmart": "Vsmart",
    "zte": "ZTE",
    "google": "Google",
    "meizu": "Meizu",
    "motorola": "Motorola",
    "moto": "Motorola",
    "nio phone": "NIO Phone",
    "oneplus": "OnePlus",
    "tesla": "Tesla",
    "unihertz": "Unihertz",
    "lenovo": "Lenovo",
    "red magic": "Red Magic",
    "moonstone": "Moonstone",
    "leeco": "LeEco",
    "blackview": "Blackview",
    "benco": "Benco",
    "fairphone": "Fairphone",
    "ulefone": "Ulefone",
    "smartisan": "Smartisan",
    "moondrop": "Moondrop",
    "gionee": "Gionee",
    "blu": "Blu",
}

# Chip families in the order they are tried; {0} is the captured model.
CHIP_RULES = [
    (r"a(\d+)\s*(?:pro|bionic)?", "A{0} Bionic"),
    (r"chip\s+a(\d+)\s*(?:pro|bionic)?", "A{0} Bionic"),
    (r"m(\d+)\s*(?:pro|max|ultra)?", "M{0}"),
    (r"snapdragon\s*(\d+\s*elite(?:\s*gen\s*\d+)?(?:\s*dành cho galaxy)?)", "Snapdragon {0}"),
    (r"snapdragon\s*(\d+\s*(?:gen\s*\d+|plus|ultra|pro|g|e|c)?\+?)", "Snapdragon {0}"),
    (r"sm\d+[a-z]*-?(\d+)", "Snapdragon {0}"),
    (r"dimensity\s*(\d+\s*(?:ultra|max|pro|plus|\+)?)", "Dimensity {0}"),
    (r"helio\s*([a-z]\d+\s*(?:ultra|max|pro|plus|\+)?)", "Helio {0}"),
    (r"mt\d+[a-z]*-?(\d+)", "MediaTek {0}"),
    (r"exynos\s*(\d+(?:\s*\d*)?)", "Exynos {0}"),
    (r"kirin\s*(\d+(?:\s*\d*)?(?:\s*(?:pro|plus|e|\+))?)", "Kirin {0}"),
    (r"tensor\s*(g\d+|\d+|)", "Tensor {0}"),
    (r"tiger\s*([a-z]\d+(?:\s*\d*)?)", "Tiger {0}"),
    (r"unisoc\s*([a-z]\d+(?:\s*\d*)?)", "Unisoc {0}"),
]
CHIP_GENERAL = r"(\w+)\s*(\d+\w*(?:\s*(?:gen|plus|ultra|pro|max|\+)?\s*\d*))"

# Named screen resolutions.
K_RESOLUTIONS = {
    "HD": (1280, 720),
    "FHD": (1920, 1080),
    "2K": (2560, 1440),
    "2.5K": (2880, 1620),
    "3K": (3200, 1800),
    "4K": (3840, 2160),
    "5K": (5120, 2880),
    "6K": (6144, 3160),
    "8K": (7680, 4320),
}

# Price bands.
PRICE_EDGES = [3_000_000, 8_000_000, 15_000_000]
PRICE_LABELS = ["Low", "Medium", "High", "Premium"]
SEGMENT_LABELS = ["Low", "Medium", "High"]
PRICE_RANKS = {"Low": 0, "Medium": 1, "High": 2, "Premium": 3}

# Products that are not smartphones.
NON_PHONE_WORDS = [
    "watch",
    "máy chơi game",
    "izi",
    "fami",
    "itel 8010",
    "itel 9310",
    "nokia 105",
    "nokia 110",
    "nokia 220",
    "nokia 3210",
    "nokia hmd",
    "pc ",
]

# Columns an encoded table does without.
TEXT_COLUMNS_TO_DROP = [
    "name", "url", "screen_tech", "screen_resolution", "os_version", "cpu", "gpu", "battery_type",
    "charging_port", "sim", "network_support", "wifi", "bluetooth", "gps", "dimensions", "weight",
    "material", "release_date", "chipset", "brand", "chip_model", "price_category",
]

# Connector names and the longest text still taken as one.
CONNECTORS = ["3.5mm", "Type C", "USB-A", "USB-C", "Bluetooth", "Wireless"]
CONNECTOR_LONGEST = 20

# Plausible headphone prices, page prices and chart range (VND).
HEADPHONE_PRICE_RANGE = (1e5, 2e7)
PAGE_PRICE_RANGE = (100_000, 50_000_000)
CHART_PRICE_CUT = 200e6

# Spec labels (lower-cased), each in order of preference.
SPEC_LABELS = {
    "chipset": ["chipset"],
    "ram": ["ram", "dung lượng ram", "ram & lưu trữ"],
    "internal_memory": ["bộ nhớ trong (rom)", "bộ nhớ trong"],
    "screen_size": ["kích thước màn hình", "màn hình rộng"],
    "screen_resolution": ["độ phân giải màn hình", "độ phân giải", "tính năng màn hình"],
    "screen_tech": ["công nghệ màn hình", "loại màn hình"],
    "refresh_rate": ["tần số quét"],
    "refresh_rate_second": ["chuẩn màn hình"],
    "camera": ["camera sau"],
    "battery": ["pin", "dung lượng pin"],
}
DEFAULT_SPEC_CATEGORY = "Thông tin chung"

# Security wording.
FINGERPRINT_WORDS = ["vân tay", "fingerprint"]
FINGERPRINT_LABEL = "Vân tay"
FACE_WORDS = ["face id", "face unlock", "nhận diện khuôn mặt"]
FACE_LABEL = "Face ID"
NO_SECURITY_LABEL = "Mật khẩu"

# Labels looked for in product page text.
PAGE_LABELS = {
    "brand": ["Hãng sản xuất", "Thương hiệu"],
    "connection": ["Kết nối", "Chuẩn kết nối", "Cổng kết nối"],
    "battery": ["Thời lượng pin", "Thời gian sử dụng", "Thời gian chơi nhạc"],
    "weight": ["Trọng lượng"],
}
PAGE_LABELS_FIRST_SHOP = {
    "brand": ["Hãng sản xuất"],
    "connection": ["Cổng kết nối"],
    "battery": ["Thời lượng sử dụng Pin"],
    "weight": ["Trọng lượng"],
}
PAGE_BRANDS = (
    "Sony|JBL|Sennheiser|Bose|Hyperx|HyperX|Anker|Baseus|Havit|Samsung|Xiaomi|Razer|Logitech|Steelseries"
)
PAGE_BRANDS_FIRST_SHOP = "Sony|JBL|Sennheiser|Bose|Hyperx|Anker|Baseus|Havit|Samsung|Xiaomi"

# The thirteen columns of a headphone row.
HEADPHONE_COLUMNS = [
    "source", "url", "name", "price_raw", "price_vnd", "brand", "type", "is_gaming", "is_wireless",
    "has_mic", "connection", "battery_life_hours", "weight_gram",
]

# Refresh rate taken for phones that state none.
DEFAULT_REFRESH_RATE = 60

# Chipsets looked up by hand.
CHIPSET_BY_NAME = {
    "Nubia Music NFC 4GB 128GB (Bản đặc biệt)": "Unisoc SC9863A",
    "vivo Y03 4GB 128GB": "Helio G85",
    "Vivo Y28": "Helio G85",
    "Samsung Galaxy A51 6GB": "Exynos 9611 8 nhân",
    "Samsung Galaxy Z Flip7 12GB 256GB": "Snapdragon 8 Elite",
    "Samsung Galaxy Z Flip7 12GB 512GB": "Snapdragon 8 Elite",
    "Huawei Mate X7 16GB 512GB": "Kirin 9010",
    "Điện thoại Nubia A56 4GB 128GB": "Unisoc T606",
    "Điện thoại Nubia A36 4GB 64GB": "Unisoc T606",
    "Samsung A36 5G 8GB - 256GB": "Exynos 1380",
    "OPPO Reno13F 5G 12GB-512GB": "Dimensity 7300",
    "OPPO Reno13F 5G 8GB-128GB": "Dimensity 7300",
    "OPPO Reno13F 5G 8GB-256GB": "Dimensity 7300",
    "OPPO Reno13F 4G 12GB - 256GB": "Snapdragon 685",
    "OPPO Reno13F 4G 12GB-512GB": "Snapdragon 685",
    "Xiaomi 17 5G": "Snapdragon 8 Elite",
    "Điện thoại Xiaomi 17 Pro": "Snapdragon 8 Elite",
    "Điện thoại Xiaomi 17 Pro Max": "Snapdragon 8 Elite",
    "Xiaomi Redmi Turbo 4": "Dimensity 8400",
    "OPPO Find N6": "Dimensity 9200",
    "Realme V30": "Dimensity 700",
    "Xiaomi POCO M7": "Helio G99",
    "Tecno POP 6 Go 4G": "MediaTek MT6739",
    "Vsmart Joy 2 Plus 2GB": "Snapdragon 450",
    "Arbutus AR8": "MediaTek MT6580",
    "360 N6": "Snapdragon 630",
    "360 N6 Lite": "Snapdragon 630",
}

# Camera resolutions looked up by hand.
CAMERA_BY_NAME = {"TECNO SPARK 30C 4GB 128GB": "50.0 MP"}

# Screen resolutions looked up by hand.
RESOLUTION_BY_NAME = {
    "Itel P55 Plus 8GB 128GB": "720 x 1612",
    "Nubia Neo 3 4G 8GB 128GB": "1080 x 2400",
    "OPPO Reno12 5G 12GB 256GB": "1080 x 2412",
    "OPPO Reno12 F 5G 8GB 256GB": "1080 x 2412",
    "realme C65 8GB 128GB": "720 x 1604",
    "realme C65 8GB 256GB": "720 x 1604",
    "realme Note 60x 3GB 64GB": "720 x 1600",
    "Sony Xperia 1VI 12GB 256GB": "1080 x 2340",
    "Sony Xperia 10VI 8GB 128GB": "1080 x 2520",
    "TECNO SPARK 30 Pro 8GB 256GB Transformer - Chỉ có tại CellphoneS": "2436 x 1080",
    "TECNO SPARK Go 1 4GB 64GB - Đã kích hoạt": "720 x 1600",
    "TECNO SPARK Go 1 4GB 64GB": "720 x 1600",
    "Realme C51": "720 x 1600",
}

# Screen technologies looked up by hand.
SCREEN_TECH_BY_NAME = {
    "Benco S1 Pro 8GB 256GB": "IPS LCD",
    "Infinix Hot 50 8GB 256GB": "IPS LCD",
    "Itel P55 Plus 8GB 128GB": "IPS LCD",
    "Nubia Neo 3 4G 8GB 128GB": "IPS LCD",
    "Nubia V60 Design 6GB 256GB": "IPS LCD",
    "TECNO SPARK 30C 4GB 128GB": "IPS LCD",
    "Xiaomi Redmi A3 4GB 128GB": "IPS LCD",
    "Điện thoại ZTE Blade A55 4GB 128GB": "IPS LCD",
    "Điện thoại ZTE Blade A55 4GB 64GB": "IPS LCD",
    "OPPO A58 8GB 128GB": "LTPS LCD",
    "OPPO A98 5G": "IPS LCD",
    "Vivo V29 5G (Snapdragon 778G+)": "AMOLED",
    "Vsmart Bee 5": "IPS LCD",
    "Redmi A2 3GB 32GB": "IPS LCD",
}

# Battery capacities (mAh) looked up by hand.
BATTERY_BY_NAME = {
    "iPhone 12 128GB | Chính hãng VN/A": 2815,
    "iPhone 12 Pro Max 256GB I Chính hãng VN/A": 3687,
    "iPhone 12 Pro Max 128GB I Chính hãng VN/A": 3687,
    "iPhone 12 Pro 128GB I Chính hãng VN/A": 2815,
    "iPhone 12 Pro 256GB | Chính hãng VN/A": 2815,
    "iPhone 12 64GB | Chính hãng VN/A": 2815,
    "iPhone 16 256GB | Chính hãng VN/A": 3561,
    "iPhone 16 Plus 256GB | Chính hãng VN/A": 4674,
    "iPhone 16 Plus 512GB | Chính hãng VN/A": 4674,
    "iPhone 16 Plus 128GB | Chính hãng VN/A": 4674,
    "iPhone 16 Plus cũ Chính hãng": 4674,
    "Điện thoại iPhone 16 Pro Max 256GB": 4685,
    "iPhone 16 Pro 1TB | Chính hãng VN/A": 3582,
    "iPhone 16 Pro Max 1TB | Chính hãng VN/A": 4685,
    "iPhone 16 Pro 256GB | Chính hãng VN/A": 3582,
    "iPhone 16 Pro 512GB | Chính hãng VN/A": 3582,
    "iPhone 16 Pro Max 512GB | Chính hãng VN/A": 4685,
    "iPhone 16 Pro Max 256GB | Chính hãng VN/A": 4685,
    "iPhone 16 Pro 128GB | Chính hãng VN/A": 3582,
    "iPhone 16 128GB | Chính hãng VN/A": 3561,
    "iPhone 14 Chính hãng VN/A": 3279,
    "iPhone 15 Chính hãng VN/A": 3349,
    "iPhone 15 Plus Chính hãng VN/A": 4383,
    "iPhone 15 Pro Chính hãng VN/A": 3274,
    "iPhone 15 Pro Max Chính hãng VN/A": 4422,
    "iPhone 16 Plus Chính hãng VN/A": 4674,
    "iPhone 16 Pro Max Chính hãng VN/A": 4685,
    "iPhone SE 4 (Camera 48MP)": 3279,
    "Nokia X7 2018": 3500,
    "iPhone 17 Pro 256GB | Chính hãng": 3582,
    "iPhone 17 Pro Max 256GB | Chính hãng": 4685,
    "iPhone Air 256GB | Chính hãng": 3561,
    "iPhone 17 256GB | Chính hãng": 3561,
    "iPhone 17e 256GB | Chính hãng": 3561,
    "iPhone 17 Pro 512GB | Chính hãng": 3582,
    "iPhone 17 Pro Max 512GB | Chính hãng": 4685,
    "iPhone 17 512GB | Chính hãng": 3561,
    "iPhone 17 Pro Max 1TB | Chính hãng": 4685,
    "iPhone 17 Pro Max 2TB | Chính hãng": 4685,
    "iPhone 17 Pro 1TB | Chính hãng": 3582,
    "iPhone 17e 512GB | Chính hãng": 3561,
    "iPhone 16e 256GB | Chính hãng VN/A": 3561,
    "iPhone 16e 512GB | Chính hãng VN/A": 3561,
    "iPhone 16e 128GB | Chính hãng VN/A": 3561,
    "iPhone Air 512GB | Chính hãng": 3561,
    "iPhone Air 1TB | Chính hãng": 3561,
}
