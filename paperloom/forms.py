"""What the domain's forms ask for: the rules of each, and the patterns of fields of all."""

from __future__ import annotations

# Rules by form type, in the order in which their errors are numbered.
RULES_OF_FORM: dict[str, tuple[dict, ...]] = {
    "bid_application": (
        {"rule_id": "bid_003", "type": "NOT_EMPTY", "field": "submission.submission_date", "error_type": "missing_field", "severity": "medium", "message": "신청일자 누락"},
        {"rule_id": "bid_004", "type": "NOT_EMPTY", "field": "submission.submitter_name", "error_type": "missing_field", "severity": "medium", "message": "신청인 성명 누락"},
        {"rule_id": "bid_date_001", "type": "DATE_ORDER", "fields": ["seal_verification.issue_date", "submission.submission_date"], "error_type": "date_logic", "severity": "medium", "message": "인감증명 발급일이 신청일보다 이후임"},
        {"rule_id": "bid_date_002", "type": "DATE_ORDER", "fields": ["submission.submission_date", "bid_info.bid_date"], "error_type": "date_logic", "severity": "medium", "message": "신청일이 입찰일보다 이후임"},
        {"rule_id": "bid_person_001", "type": "NAME_MATCH", "fields": ["applicant.representative", "submission.submitter_name"], "error_type": "format", "severity": "low", "message": "대표자 성명과 신청인 성명 불일치"},
        {"rule_id": "bid_addr_001", "type": "ADDR_CONTAINS", "field_value": "applicant.address", "field_contained": "applicant.business_location", "error_type": "format", "severity": "low", "message": "사업장소재지가 주소에 포함되지 않음"},
    ),
    "equipment_checklist": (
        {"rule_id": "chk_001", "type": "ARRAY_LENGTH", "field": "checklist_items", "expected_length": 6, "error_type": "missing_field", "severity": "high", "message": "checklist_items 배열 길이 ≠ 6"},
        {"rule_id": "chk_002", "type": "ARRAY_SEQUENCE", "field": "checklist_items", "key": "item_number", "expected_sequence": [1, 2, 3, 4, 5, 6], "error_type": "format", "severity": "high", "message": "item_number 1~6 순서 불일치"},
        {"rule_id": "chk_003", "type": "ARRAY_ENUM", "field": "checklist_items", "key": "result", "allowed_values": ["O", "X", "?"], "error_type": "format", "severity": "high", "message": "result 값이 O/X/? 외 값 포함"},
        {"rule_id": "chk_004", "type": "NOT_EMPTY", "field": "writer.name", "error_type": "missing_field", "severity": "medium", "message": "작성자 성명 누락"},
    ),
    "supply_request": (
        {"rule_id": "arith_001", "type": "ARITHMETIC", "result_field": "total", "operands": ["quantity", "unit_price"], "operator": "multiply", "error_type": "arithmetic", "severity": "high", "message": "합계 ≠ 수량 × 단가"},
        {"rule_id": "date_001", "type": "DATE_ORDER", "fields": ["request_date"], "error_type": "date_logic", "severity": "medium", "message": "날짜 순서 논리 위반"},
        {"rule_id": "code_001", "type": "REGEX_MATCH", "field": "nsn", "pattern": r"^\d{4}-\d{2}-\d{3}-\d{4}$", "error_type": "code_format", "severity": "medium", "message": "NSN 형식 불일치 (NNNN-NN-NNN-NNNN)"},
        {"rule_id": "code_002", "type": "REGEX_MATCH", "field": "k_nsn", "pattern": r"^KN-\d{5}-\d{4}$", "error_type": "code_format", "severity": "medium", "message": "K-NSN 형식 불일치 (KN-NNNNN-NNNN)"},
        {"rule_id": "miss_001", "type": "NOT_EMPTY", "field": "unit_code", "error_type": "missing_field", "severity": "high", "message": "필수 필드 누락: unit_code"},
    ),
}
# Patterns of data types, and how a value that misses one is put in form.
TYPE_PATTERNS: tuple[dict, ...] = (
    {"data_type": "date", "pattern": r"^\d{4}년 \d{1,2}월 \d{1,2}일$", "severity": "medium", "normalize": {"regex": r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", "template": "{1}년 {2:02d}월 {3:02d}일"}},
    {"data_type": "phone", "pattern": r"^\d{2,3}-\d{3,4}-\d{4}$", "severity": "low", "normalize": {"strip_chars": " "}},
    {"data_type": "amount", "pattern": r"^\d+$", "severity": "medium"},
)
# Patterns of fields.
KEY_PATTERNS: tuple[dict, ...] = (
    {"field_key": "corporate_reg_number", "pattern": r"^\d{5}-\d{7}$", "severity": "medium"},
    {"field_key": "business_reg_number", "pattern": r"^\d{3}-\d{2}-\d{5}$", "severity": "medium"},
    {"field_key": "nsn", "pattern": r"^\d{4}-\d{2}-\d{3}-\d{4}$", "severity": "medium"},
    {"field_key": "k_nsn", "pattern": r"^KN-\d{5}-\d{4}$", "severity": "medium"},
    {"field_key": "unit_code", "pattern": r"^\d{2,4}$", "severity": "low"},
    {"field_key": "announcement_number", "pattern": r"^\d{4}-DAPA-[A-Z]+-\d+$", "severity": "low"},
    {"field_key": "seal_issue_number", "pattern": r"^\d{4}-[A-Z]+-\d+$", "severity": "low"},
)
