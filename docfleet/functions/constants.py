"""Fixed values. They have to be exactly these for results to agree with the replaced system."""

# file extension -> label shown for the type
TYPE_LABELS = {
    "pdf": "PDF文档",
    "docx": "Word文档",
    "doc": "Word文档",
    "xlsx": "Excel表格",
    "xls": "Excel表格",
    "pptx": "PPT演示",
    "ppt": "PPT演示",
    "png": "PNG图片",
    "jpg": "JPG图片",
    "jpeg": "JPG图片",
    "svg": "SVG矢量图",
    "md": "Markdown",
}

# conversion target -> label shown for it
TARGET_LABELS = {
    "pdf": "PDF",
    "docx": "Word",
    "xlsx": "Excel",
    "images": "图片",
    "png": "PNG",
    "jpg": "JPG",
}

# names used on either side of "_to_" in a conversion key
KEY_FROM = {
    "docx": "word",
    "doc": "word",
    "xlsx": "excel",
    "xls": "excel",
    "pptx": "pptx",
    "ppt": "pptx",
    "md": "markdown",
}
KEY_TO = {
    "word": "word",
    "docx": "word",
    "doc": "word",
    "xlsx": "excel",
    "xls": "excel",
    "pptx": "pptx",
    "ppt": "pptx",
    "pdf": "pdf",
    "images": "images",
    "png": "png",
    "jpg": "jpg",
    "jpeg": "jpg",
    "svg": "svg",
    "md": "markdown",
}

# output format -> media type, and what it is when the format is unknown
CONTENT_TYPES = {
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "html": "text/html",
    "markdown": "text/markdown",
    "csv": "text/csv",
    "png": "image/png",
    "svg": "image/svg+xml",
    "ico": "image/x-icon",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
JSON_TYPE = "application/json"

# conversion tokens that are not themselves output formats -> the format they produce
FORMAT_OF_TOKEN = {
    "word": "docx",
    "excel": "xlsx",
    "images": "png",
}

# media type -> extension of the downloaded file, and what it is when the type is unknown
DOWNLOAD_EXTENSIONS = {
    "application/pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
    "image/png": "png",
    "image/jpeg": "jpg",
    "application/zip": "zip",
}
# media types the download table lacks
MORE_DOWNLOAD_EXTENSIONS = {
    "text/html": "html",
    "text/markdown": "md",
    "text/csv": "csv",
    "image/svg+xml": "svg",
    "image/x-icon": "ico",
}
DEFAULT_DOWNLOAD_EXTENSION = "pdf"

# target -> extension of the result name
RESULT_EXTENSIONS = {
    "word": "docx",
    "excel": "pdf",
    "xlsx": "xlsx",
    "pptx": "pptx",
    "pdf": "pdf",
    "markdown": "pdf",
    "images": "png",
    "svg": "pdf",
}

# operation -> queue
QUEUES = {
    "convert": "conversions",
    "batch": "batch",
    "merge": "pdf_operations",
    "split": "pdf_operations",
    "extract": "pdf_operations",
    "to_images": "conversions",
    "from_images": "conversions",
}

# order in which extensions are tried when a stored file is looked up by id
LOOKUP_EXTENSIONS = ("", ".pdf", ".docx", ".xlsx", ".pptx", ".png", ".svg", ".md")

# (from, to, label) offered for a file, first one is the default
OFFERED_CONVERSIONS = (
    ("pdf", "word", "PDF → Word"),
    ("pdf", "images", "PDF → 图片"),
    ("docx", "pdf", "Word → PDF"),
    ("doc", "pdf", "Word → PDF"),
    ("xlsx", "pdf", "Excel → PDF"),
    ("xls", "pdf", "Excel → PDF"),
    ("pptx", "pdf", "PPTX → PDF"),
    ("ppt", "pdf", "PPTX → PDF"),
    ("png", "pdf", "PNG → PDF"),
    ("jpg", "pdf", "JPG → PDF"),
    ("jpeg", "pdf", "JPG → PDF"),
    ("svg", "png", "SVG → PNG"),
    ("svg", "pdf", "SVG → PDF"),
    ("md", "pdf", "Markdown → PDF"),
)
DEFAULT_TARGET = "pdf"

# conversion types by the list that names them
DECLARED_CONVERSIONS = (
    "pdf_to_word",
    "pdf_to_excel",
    "pdf_to_pptx",
    "pdf_to_images",
    "pdf_to_html",
    "word_to_pdf",
    "word_to_html",
    "word_to_markdown",
    "excel_to_pdf",
    "excel_to_csv",
    "excel_to_html",
    "pptx_to_pdf",
    "pptx_to_images",
    "markdown_to_pdf",
    "markdown_to_html",
    "markdown_to_word",
    "svg_to_png",
    "svg_to_pdf",
    "png_to_svg",
    "png_to_ico",
    "png_to_pdf",
)
BATCH_CONVERSIONS = (
    "pdf_to_word",
    "pdf_to_images",
    "pdf_to_html",
    "pdf_to_pptx",
    "word_to_pdf",
    "word_to_markdown",
    "excel_to_pdf",
    "excel_to_csv",
    "pptx_to_pdf",
    "markdown_to_pdf",
    "markdown_to_html",
    "markdown_to_word",
    "svg_to_png",
    "svg_to_pdf",
    "png_to_svg",
    "png_to_ico",
    "png_to_pdf",
    "jpg_to_pdf",
    "jpeg_to_pdf",
)
SINGLE_CONVERSIONS = BATCH_CONVERSIONS + ("pptx_to_images",)
ADVERTISED_CONVERSIONS = (
    "pdf_to_word",
    "pdf_to_images",
    "pdf_to_pptx",
    "word_to_pdf",
    "excel_to_pdf",
    "pptx_to_pdf",
    "markdown_to_pdf",
    "svg_to_png",
    "svg_to_pdf",
    "png_to_pdf",
)

# first bytes of the file, by extension (hexadecimal)
SIGNATURES = {
    "docx": "504B0304",
    "xlsx": "504B0304",
    "pptx": "504B0304",
    "png": "89504E47",
}

# directories left out of an inventory
EXCLUDED_DIRS = (".git", "node_modules", "frontend/dist", "venv", ".venv", "__pycache__")
# suffixes of temporary files, how many of each stay, and for how long
TEMP_SUFFIXES = (".tmp", ".draft", ".bak")
KEEP_RECENT_TEMP = 3
TEMP_MAX_AGE_HOURS = 24
EMPTY_FILE_EXEMPT = "__init__.py"
RESULT_TTL_HOURS = 24
LARGE_LOG_BYTES = 1024 * 1024

# severities and issue/decision/phase states, most pressing severity first
SEVERITIES = ("critical", "high", "medium", "low")
UNRESOLVED = ("open", "in-progress")

# features every project starts with: (category, description, steps, priority)
BASE_FEATURES = (
    ("functional", "Application loads without errors", ("Open application", "Check console for errors"), 1),
    ("functional", "Home page displays correctly", ("Navigate to home", "Verify content renders"), 1),
    ("functional", "Navigation between pages works", ("Click nav links", "Verify page changes"), 1),
    ("functional", "Responsive design on mobile", ("Resize to mobile", "Verify layout"), 2),
    ("functional", "Error handling displays user-friendly messages", ("Trigger error", "Verify message"), 2),
    ("performance", "Initial page load under 3 seconds", ("Measure load time",), 2),
    ("security", "No XSS vulnerabilities", ("Test input sanitization",), 3),
    ("ui", "Loading states display during async operations", ("Trigger async action", "Check loader"), 2),
    ("functional", "Form validation works correctly", ("Submit invalid form", "Verify errors"), 2),
    ("functional", "Data persists across sessions", ("Save data", "Refresh page", "Verify data"), 2),
)
API_FEATURES = (
    ("functional", "REST endpoints return correct status codes", ("Test each endpoint", "Verify status"), 1),
    ("functional", "Authentication works correctly", ("Login", "Verify token"), 1),
    ("functional", "Rate limiting protects API", ("Send many requests", "Verify 429"), 2),
)

# messages
MSG_UNSUPPORTED = "Unsupported conversion type: "
MSG_NO_PDF = "PDF file not found"
MSG_NO_FILE = "File not found"
MSG_LITTLE_TEXT = "Very little text content"
MSG_MAYBE_EMPTY = "May be empty or have rendering issues"

# metric and quality fields of a phase report
PHASE_METRICS = (
    "files_created",
    "files_modified",
    "lines_of_documentation",
    "lines_of_code",
    "tests_written",
    "tests_passing",
    "decisions_made",
    "issues_resolved",
    "issues_discovered",
)
PHASE_CHECKS = ("documentation_complete", "code_reviewed", "tests_passing_check", "standards_followed")

# every character str.strip() removes, as the inside of a regular-expression class that both
# java.util.regex and RE2 accept
BLANKS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# the same characters themselves
BLANK_CHARS = "".join(
    map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# a run of them for java.util.regex, whose Unicode white space lacks four separators
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"
