"""Tables and character sets that decide results, stated in one place.

Everything here is data. Changing an entry changes what a dataset contains, so
these values are kept as plain text and are not computed.
"""

# --- fixed values: file suffix -> language -----------------------------------
LANGUAGE_BY_EXTENSION = {
    ".py": "python",
    ".pyw": "python",
    ".pyi": "python",
    ".js": "javascript",
    ".mjs": "javascript",
    ".cjs": "javascript",
    ".ts": "typescript",
    ".tsx": "typescript",
    ".jsx": "javascript",
    ".java": "java",
    ".kt": "kotlin",
    ".kts": "kotlin",
    ".scala": "scala",
    ".go": "go",
    ".rs": "rust",
    ".swift": "swift",
    ".m": "objective-c",
    ".mm": "objective-c++",
    ".cpp": "cpp",
    ".cxx": "cpp",
    ".cc": "cpp",
    ".hpp": "cpp",
    ".hxx": "cpp",
    ".h": "c",
    ".c": "c",
    ".cs": "csharp",
    ".rb": "ruby",
    ".php": "php",
    ".pl": "perl",
    ".pm": "perl",
    ".sh": "shell",
    ".bash": "shell",
    ".zsh": "shell",
    ".fish": "shell",
    ".ksh": "shell",
    ".ps1": "powershell",
    ".psm1": "powershell",
    ".cmd": "cmd",
    ".bat": "cmd",
    ".lua": "lua",
    ".r": "r",
    ".jl": "julia",
    ".dart": "dart",
    ".sql": "sql",
    ".yml": "yaml",
    ".yaml": "yaml",
    ".json": "json",
    ".toml": "toml",
    ".ini": "ini",
    ".cfg": "ini",
    ".md": "markdown",
    ".txt": "text",
    ".terminal": "terminal",
    ".cmdlog": "terminal",
}

UNKNOWN_LANGUAGE = "unknown"

# --- fixed values: which files are ingested by default -----------------------
DEFAULT_INCLUDE_EXTENSIONS = (
    ".py", ".js", ".ts", ".tsx", ".java", ".go", ".rs", ".cpp", ".c", ".cs",
    ".rb", ".php", ".swift", ".m", ".mm", ".pl", ".pm", ".sh", ".ps1", ".psm1",
    ".cmd", ".bat", ".scala", ".kt", ".dart", ".lua", ".r", ".jl", ".yaml",
    ".yml", ".json", ".toml", ".ini", ".cfg", ".md", ".txt", ".terminal",
    ".cmdlog",
)

DEFAULT_EXCLUDE_DIRS = (".git", "node_modules", "vendor", "dist", "build", "__pycache__")

# --- fixed values: command mining ---------------------------------------------
DEFAULT_SHELLS = (
    "bash", "zsh", "fish", "powershell", "cmd", "sh", "ksh", "csh", "pwsh",
    "nushell", "xonsh", "busybox",
)

DEFAULT_COMMAND_PATTERNS = (
    "*.sh", "*.bash", "*.zsh", "*.fish", "*.ps1", "*.psm1", "*.cmd", "*.bat",
    "*.ksh", "*.csh", "*.history", "*commands.txt", "*history.txt", "*.md",
)

DEFAULT_IGNORE_PATTERNS = ("*.png", "*.jpg", "*.jpeg", "*.gif", "*.pdf")

# A line starting with one of these, in any letter case, is a comment.
COMMENT_STARTS = ("#", "//", "rem ", "REM ", "::", ";")

# The first of these at the start of a line is a shell prompt.
PROMPT_STARTS = ("$", "#", "%", ">", "PS ", "PS>", "PS C:\\", "C:\\", "λ")

# --- fixed values: repository metadata ----------------------------------------
DEPENDENCY_MANIFESTS = {
    "requirements.txt": "python",
    "pyproject.toml": "python",
    "package.json": "node",
    "Cargo.toml": "rust",
    "go.mod": "go",
    "pom.xml": "java",
    "build.gradle": "java",
    "composer.json": "php",
}

CI_LOCATIONS = (
    ".github/workflows",
    ".gitlab-ci.yml",
    "azure-pipelines.yml",
    "circle.yml",
    "Jenkinsfile",
    "appveyor.yml",
    "bitrise.yml",
)

CI_KIND = "workflow"

# --- fixed values: character classes (Java regex) ------------------------------
# Characters that Python treats as white space.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\t\n\x0B\x0C\r\x1C-\x20\x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
)
# Classes are written out character by character: Java scans a class of single Latin-1
# characters with one table lookup, and a class with ranges several times slower.
# Line boundaries of Python's ``str.splitlines``, apart from CR LF, which is one boundary.
LINE_BREAK = r"[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
# The same without the line feed, as a class and as characters.
FOREIGN_LINE_BREAK = r"[\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
FOREIGN_LINE_BREAK_CHARS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# Runs that whitespace normalisation replaces by one space.
HORIZONTAL_RUN = r"[\t\x0B\x0C\r]+"
HORIZONTAL_CHARS = "\t\x0b\x0c\r"
# Three or more line feeds shrink to two.
BLANK_LINES_RUN = r"\n{3,}"
# Bytes that make a file binary.
BINARY_BYTES = (
    r"[\x00\x01\x02\x03\x04\x05\x06\x0B\x0E\x0F\x10\x11\x12\x13\x14\x15\x16\x17\x18\x19\x1A"
    r"\x1C\x1D\x1E\x1F]"
)
# A suffix needs at least one character before its dot and after it.
SUFFIX = r"(?s)^.+(\.[^.]+)\z"
