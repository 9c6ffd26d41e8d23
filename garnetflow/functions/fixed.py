"""Word lists, catalogues and rule tables that results depend on. They are data, not logic."""

from __future__ import annotations

# --- fixed values: stop words by tokeniser profile ---

STOP_WORDS = {
    "train": (
        "a an and are as at be by for from has he in is it its of on that the to was will with this but they have had what when where who which why how "
        "can could may might must shall should would or not no nor if then than so such only own same some these those very also just more most other into "
        "through during before after above below between under again further once here there all both each few any been being do does did doing out off over up "
        "down about against because until while within along following across behind beyond plus except however since unless whereas whether "
        "vulnerability vulnerabilities vulnerable issue issues flaw flaws version versions release releases attacker attackers user users allows allow via using "
        "data code file files access system systems found used use uses fix fixed resolved patch product products component components "
        "application applications software function functions method methods value values parameter parameters request requests response responses "
        "certain specific particular multiple various related associated affected result results cause causes perform execute run process "
        "obtain gain achieve lead due lack missing improper insufficient incorrect invalid"
    ),
    "taxonomy": (
        "the and for with from that this are was were been being have has had but not can will would could should may might must into through during before after "
        "vulnerability allows attacker remote via user application system version versions prior component"
    ),
    "serving": (
        "the and for with from that this are was were been being have has had but not can will would could should may might must shall into through during before "
        "after above below between under again further then once here there when where why how all both each few more most other some such only own same than too very "
        "just also any these those what which who whom whose out off over down does did doing nor about against because until while upon within "
        "vulnerability vulnerabilities vulnerable issue issues flaw flaws product products component components application applications software "
        "version versions release releases fix fixed resolved patch patched attacker attackers user users access system systems data code file files "
        "found used use uses using allows allow via perform execute run process obtain gain achieve lead leads function functions method methods "
        "value values parameter parameters request requests response responses certain specific particular multiple various related associated affected "
        "improper insufficient incorrect invalid due lack missing without cause causes caused result results resulting leading enable enabled "
        "make makes made making contain contains containing included including present exists existing"
    ),
    "batch": "a an and are as at be by for from has he in is it its of on that the to was will with",
    "retrieval": (
        "the a an and or but in on at to for of with by from as is was are were be been being have has had do does did will would could should may might "
        "can this that these those it its they them their"
    ),
    "report": (
        "the and for with from that this are was were been being have has had but not can will would could should may might must "
        "vulnerability vulnerabilities vulnerable issue issues flaw flaws product products component components application applications software "
        "version versions release releases attacker attackers user users access system systems data code file files allows allow via perform execute run process"
    ),
    "ranking": (
        "the and for with from that this are was were been being have has had but not can will would could should may might must into through during before after "
        "above below between under again further then once here there when where why how all each other some such only own same than too very"
    ),
    "cwe_name": "improper insufficient incorrect missing lack inadequate the of in to for and or a an",
    "significant": "the and for with that this from can are has have when where which who will would could should",
}
STOP_WORDS = {k: v.split() for k, v in STOP_WORDS.items()}

# --- fixed values: attack vectors (name, weaknesses, description, priority) ---

VECTOR_CATALOG = [
    ("xss", ["79", "80", "83"], "Cross-Site Scripting", 1),
    ("sql_injection", ["89"], "SQL Injection", 1),
    ("rce", ["94", "95"], "Remote Code Execution", 1),
    ("command_injection", ["77", "78"], "OS Command Injection", 1),
    ("path_traversal", ["22", "23", "36"], "Path Traversal", 1),
    ("ssrf", ["918"], "Server-Side Request Forgery", 1),
    ("deserialization", ["502"], "Deserialization Vulnerabilities", 1),
    ("auth_bypass", ["287", "288", "290", "302", "306"], "Authentication Bypass", 1),
    ("authz_bypass", ["285", "639"], "Authorization Bypass", 1),
    ("file_upload", ["434"], "File Upload Vulnerabilities", 1),
    ("csrf", ["352"], "Cross-Site Request Forgery", 2),
    ("xxe", ["611"], "XML External Entity", 2),
    ("ldap_injection", ["90"], "LDAP Injection", 2),
    ("jndi_injection", ["917"], "JNDI/Expression Language Injection", 2),
    ("privilege_escalation", ["269", "274", "266", "250"], "Privilege Escalation", 2),
    ("buffer_overflow", ["119", "120", "121", "122", "787", "788"], "Buffer Overflow", 2),
    ("idor", ["639", "284"], "Insecure Direct Object Reference", 2),
    ("http_desync", ["444"], "HTTP Request Smuggling", 2),
    ("hardcoded_credentials", ["798", "259", "321"], "Hard-coded Credentials", 2),
    ("info_disclosure", ["200", "209", "213", "215", "532"], "Information Disclosure", 2),
    ("dos", ["400", "770", "400", "835", "674"], "Denial of Service", 3),
    ("nosql_injection", ["943"], "NoSQL Injection", 3),
    ("xpath_injection", ["643"], "XPath Injection", 3),
    ("open_redirect", ["601"], "Open Redirect", 3),
    ("session_fixation", ["384"], "Session Fixation", 3),
    ("crypto_failure", ["327", "328", "329", "326"], "Cryptographic Failures", 3),
    ("integer_overflow", ["190", "191"], "Integer Overflow", 3),
    ("use_after_free", ["416"], "Use After Free", 3),
    ("null_pointer", ["476"], "NULL Pointer Dereference", 3),
    ("format_string", ["134"], "Format String Vulnerability", 3),
    ("email_injection", ["93"], "Email Header Injection", 3),
    ("race_condition", ["362", "366", "367"], "Race Condition", 3),
    ("ssti", ["1336"], "Server-Side Template Injection", 3),
    ("input_validation", ["20", "1284"], "Improper Input Validation", 3),
    ("code_injection", ["94", "95"], "Code Injection", 3),
]

#: The display name of hard-coded credentials is kept under a shorter key, so the vector's own id has none.
VECTOR_NAMES = {("hardcoded_creds" if n == "hardcoded_credentials" else n): d for n, _, d, _ in VECTOR_CATALOG}

# --- fixed values: vectors of each weakness in the hierarchy ---

CWE_VECTORS = [
    ("20", ["input_validation"]), ("22", ["path_traversal"]), ("23", ["path_traversal"]), ("36", ["path_traversal"]), ("73", ["path_traversal"]),
    ("74", ["injection"]), ("77", ["command_injection"]), ("78", ["command_injection"]), ("79", ["xss"]), ("89", ["sql_injection"]),
    ("90", ["ldap_injection"]), ("91", ["xml_injection", "xxe"]), ("93", ["crlf_injection", "http_desync"]), ("94", ["code_injection", "rce"]),
    ("95", ["code_injection", "rce"]), ("96", ["code_injection"]), ("98", ["file_upload", "rce"]), ("99", ["rce"]), ("113", ["http_desync"]),
    ("119", ["buffer_overflow", "rce"]), ("120", ["buffer_overflow"]), ("121", ["buffer_overflow"]), ("122", ["buffer_overflow"]),
    ("125", ["buffer_overflow"]), ("129", ["input_validation"]), ("134", ["format_string", "rce"]), ("190", ["integer_overflow"]),
    ("191", ["integer_overflow"]), ("200", ["info_disclosure"]), ("201", ["info_disclosure"]), ("209", ["info_disclosure"]),
    ("213", ["info_disclosure"]), ("215", ["info_disclosure"]), ("250", ["privilege_escalation"]), ("259", ["hardcoded_credentials"]),
    ("266", ["privilege_escalation"]), ("268", ["privilege_escalation"]), ("269", ["privilege_escalation"]), ("274", ["privilege_escalation"]),
    ("284", ["authz_bypass"]), ("285", ["authz_bypass"]), ("287", ["auth_bypass"]), ("288", ["auth_bypass"]), ("290", ["auth_bypass"]),
    ("294", ["auth_bypass", "session_fixation"]), ("295", ["auth_bypass", "crypto_failure"]), ("306", ["auth_bypass"]), ("307", ["auth_bypass"]),
    ("321", ["hardcoded_credentials"]), ("326", ["crypto_failure"]), ("327", ["crypto_failure"]), ("328", ["crypto_failure"]),
    ("330", ["crypto_failure"]), ("331", ["crypto_failure"]), ("346", ["csrf"]), ("352", ["csrf"]), ("359", ["info_disclosure"]),
    ("362", ["race_condition"]), ("366", ["race_condition"]), ("367", ["race_condition"]), ("384", ["session_fixation"]), ("400", ["dos"]),
    ("404", ["dos"]), ("415", ["use_after_free"]), ("416", ["use_after_free", "rce"]), ("425", ["authz_bypass"]), ("434", ["file_upload", "rce"]),
    ("472", ["session_fixation"]), ("476", ["null_pointer"]), ("502", ["deserialization", "rce"]), ("532", ["info_disclosure"]),
    ("538", ["info_disclosure"]), ("601", ["open_redirect"]), ("611", ["xxe"]), ("613", ["session_fixation"]), ("616", ["file_upload"]),
    ("639", ["authz_bypass"]), ("674", ["dos"]), ("690", ["null_pointer"]), ("770", ["dos"]), ("787", ["buffer_overflow", "rce"]),
    ("798", ["hardcoded_credentials"]), ("827", ["xxe"]), ("835", ["dos"]), ("862", ["authz_bypass"]), ("863", ["idor"]),
    ("917", ["jndi_injection", "rce"]), ("918", ["ssrf"]), ("943", ["nosql_injection"]), ("1284", ["input_validation"]), ("1336", ["ssti"]),
]

# --- fixed values: vectors of each weakness in reports ---

REPORT_CWE_VECTORS = [
    ("22", ["path_traversal"]), ("23", ["path_traversal"]), ("77", ["command_injection"]), ("78", ["command_injection"]), ("79", ["xss"]),
    ("80", ["xss"]), ("89", ["sql_injection"]), ("90", ["ldap_injection"]), ("93", ["crlf_injection"]), ("119", ["buffer_overflow"]),
    ("120", ["buffer_overflow"]), ("121", ["buffer_overflow"]), ("122", ["buffer_overflow"]), ("250", ["privilege_escalation"]),
    ("266", ["privilege_escalation"]), ("269", ["privilege_escalation"]), ("284", ["authentication"]), ("285", ["authz_bypass", "authorization"]),
    ("287", ["auth_bypass", "authentication"]), ("288", ["auth_bypass", "authentication"]), ("290", ["auth_bypass", "authentication"]),
    ("306", ["auth_bypass", "authentication"]), ("352", ["csrf"]), ("444", ["http_smuggling"]), ("501", ["trust_boundary"]),
    ("502", ["deserialization"]), ("611", ["xxe"]), ("639", ["authentication"]), ("643", ["xpath_injection"]), ("652", ["xml_injection"]),
    ("665", ["privilege_escalation"]), ("732", ["privilege_escalation"]), ("787", ["buffer_overflow"]), ("798", ["authentication"]),
    ("862", ["authz_bypass", "authorization"]), ("863", ["authz_bypass", "idor"]), ("917", ["code_injection", "jndi_injection"]), ("918", ["ssrf"]),
]



# --- fixed values: relevance of a weakness to a description ---

CWE_PRIORITY = {"502": 50, "78": 45, "89": 45, "94": 45, "77": 40, "79": 40, "917": 40, "918": 40, "22": 35, "434": 35, "611": 35, "119": 30, "416": 30, "787": 30, "306": 25, "352": 25, "862": 25}
#: Any word of each set in the text gives the bonus to the weaknesses.
CWE_TRIGGERS = [
    ([["deserializ", "jndi", "ldap", "lookup", "unmarsh", "pickle"]], {"502": 100, "917": 50}),
    ([["inject", "execut", "eval", "code execution"], ["code", "arbitrary"]], {"94": 80}),
    ([["inject", "execut", "eval", "code execution"], ["command", "shell", "os"]], {"77": 80, "78": 80}),
    ([["sql", "database", "query"]], {"89": 100}),
    ([["xss", "cross-site scripting", "script injection"]], {"79": 100}),
    ([["path traversal", "directory traversal", "../", "..\\", "path manipulation"]], {"22": 80}),
    ([["ssrf", "server-side request", "internal request", "url fetch"]], {"918": 100}),
    ([["xxe", "xml external entity", "xml injection"]], {"611": 100}),
    ([["buffer overflow", "buffer overrun", "heap overflow", "stack overflow"]], {"119": 80, "787": 80}),
    ([["authentication bypass", "auth bypass", "without authentication"]], {"306": 80}),
    ([["authorization bypass", "privilege escalation", "unauthorized access"]], {"862": 80, "269": 80}),
]
#: The trigger that the batch relabelling does not have.
COMMAND_TRIGGER = 2
CWE_PENALTY = {"20": 20, "703": 20, "707": 20, "400": 15}

# --- fixed values: manual patterns (vector, keywords, specificity, support) ---

MANUAL_PATTERNS = [
    ("deserialization", ["jndi"], 0.95, 100),
    ("deserialization", ["ldap"], 0.90, 80),
    ("deserialization", ["lookup"], 0.85, 70),
    ("deserialization", ["unmarsh"], 0.92, 60),
    ("deserialization", ["pickle"], 0.94, 50),
    ("jndi_injection", ["jndi"], 0.95, 100),
    ("jndi_injection", ["ldap"], 0.90, 80),
    ("jndi_injection", ["naming"], 0.85, 60),
    ("sql_injection", ["union", "select"], 0.95, 200),
    ("sql_injection", ["or", "="], 0.70, 150),
]

# --- fixed values: words that show a protocol in a description ---

PROTOCOLS = {
    "ldap": ["ldap", "directory", "active directory", "ad"],
    "smtp": ["smtp", "email", "mail server", "sendmail"],
    "imap": ["imap", "email", "mail"],
    "sql": ["sql", "database", "mysql", "postgresql", "oracle", "mssql"],
    "xml": ["xml", "soap", "wsdl"],
    "xpath": ["xpath", "xml"],
    "dns": ["dns", "domain name"],
    "ntp": ["ntp", "time server"],
    "snmp": ["snmp", "network management"],
    "bluetooth": ["bluetooth", "ble"],
    "nfc": ["nfc", "near field"],
    "usb": ["usb", "universal serial bus"],
}

IMPORTANT_WORDS = ["command", "injection", "execute", "arbitrary", "code", "exploit", "vulnerability"]
GENERIC_NAMES = ["injection", "command", "code execution", "exploit"]
SEVERE_WORDS = ["critical", "execute", "arbitrary"]
FALLBACK_TECHNIQUES = ["T1190", "T1059", "T1203"]

# --- fixed values: words that show a vector in a description ---

VECTOR_KEYWORDS = {
    "sql_injection": ["sql injection", "sqli", "sql query", "sql command"],
    "ldap_injection": ["ldap injection", "ldap query", "ldap", "ldap endpoints", "ldap servers"],
    "command_injection": ["command injection", "os command", "shell injection", "execute commands"],
    "code_injection": ["code injection", "arbitrary code", "code execution"],
    "jndi_injection": ["jndi", "jndi lookup", "jndi injection"],
    "template_injection": ["template injection", "ssti", "server-side template"],
    "xss": ["cross-site scripting", "xss", "dom-based", "reflected xss", "stored xss", "javascript injection"],
    "deserialization": ["deserialization", "deserialize", "unserialize", "pickle", "object injection", "serialized"],
    "buffer_overflow": ["buffer overflow", "stack overflow", "heap overflow", "memory corruption", "overflow a buffer", "overflow a heap", "overflow a stack", "heap based buffer", "stack based buffer", "buffer overrun"],
    "path_traversal": ["path traversal", "directory traversal", "file inclusion", "lfi", "rfi", "traverse directories", "access files outside"],
    "authentication": ["authentication", "credential", "password", "login", "session", "bypass", "auth bypass"],
    "privilege_escalation": ["privilege escalation", "escalate privileges", "escalate their privileges", "elevate privileges", "privilege elevation", "gain elevated privileges", "gain higher privileges"],
    "csrf": ["csrf", "cross-site request forgery", "xsrf"],
    "ssrf": ["ssrf", "server-side request forgery"],
    "xxe": ["xxe", "xml external entity"],
    "rce": ["remote code execution", "rce", "execute arbitrary code", "arbitrary code execution", "execute code"],
    "dos": ["denial of service", "dos", "resource exhaustion"],
}
VECTOR_PATTERNS = {
    "buffer_overflow": ["overflow.*(?:heap|stack|buffer)", "(?:heap|stack|buffer).*overflow", r"memory\s+corruption"],
    "privilege_escalation": ["escalate.*privilege", "elevate.*privilege", "gain.*(?:elevated|higher|admin).*privilege"],
    "path_traversal": [r"(?:path|directory)\s+traversal", "traverse.*(?:path|director(?:y|ies))", "access.*(?:file|director(?:y|ies)).*outside"],
}
#: Words of an attack pattern that count against it where the vector was not detected.
SPECIFIC_PATTERNS = {
    "xss": ["cross-site scripting", "xss", "dom-based", "javascript injection"],
    "csrf": ["cross-site request forgery", "csrf", "xsrf"],
    "sql_injection": ["sql injection", "sqli", "blind sql"],
    "deserialization": ["deserialization", "deserialize", "object injection", "serialized"],
    "ssrf": ["ssrf", "server-side request forgery"],
    "buffer_overflow": ["buffer overflow", "stack overflow", "heap overflow"],
    "path_traversal": ["path traversal", "directory traversal"],
}
IMPACT_WORDS = [
    "privilege escalation", "escalate privileges", "gain privileges", "unauthorized access", "bypass authentication", "bypass authorization",
    "session takeover", "session hijacking", "session fixation", "steal session", "session theft",
    "information disclosure", "data disclosure", "data leakage", "sensitive information", "confidential data", "expose data",
    "remote code execution", "arbitrary code execution", "execute code", "command execution", "rce",
    "denial of service", "dos", "crash", "resource exhaustion",
    "data modification", "tamper", "modify data", "corrupt data",
]
CONTEXT_PREFIXES = ["improper ", "insufficient ", "incorrect ", "missing ", "inadequate "]
