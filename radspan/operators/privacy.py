"""Privacy: pattern scans, text scrubbing, identifier inventories, pseudonyms, date shifts and tag profiles."""

from __future__ import annotations

import functools
import itertools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: named scan patterns
_MONTHS = r"(?i)\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\w*\s+\d{1,2},?\s+\d{4}\b"
_TITLED = r"\b(?:Shri|Smt|Kumari?|Sri|Thiru|Selvi|Dr|Prof|Mr|Mrs|Ms)\.?\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,3}\b"
SCAN = {
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "phone_us": r"\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b",
    "aadhaar": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    "pan": r"\b[A-Z]{5}\d{4}[A-Z]\b",
    "voter_id": r"\b[A-Z]{3}\d{7}\b",
    "driving_license": r"\b[A-Z]{2}[-/]\d{10,13}\b",
    "passport": r"\b[A-Z]\d{7}\b",
    "uhid": r"(?i)\b(?:UHID|MRN|HRN|HOSP)[-:/]?\s*\d{4,12}\b",
    "phone_india": r"(?<!\d)(?:\+91[\s-]?|0)\d{10}(?!\d)",
    "phone_landline": r"\b0\d{2,4}[-\s]?\d{6,8}\b",
    "name_indian": _TITLED,
    "surname_indian": r"(?i)\b(?:Kumar|Singh|Sharma|Verma|Gupta|Patel|Shah|Jain|Mishra|Pandey|Reddy|Rao|Nair|Menon|Pillai|Iyer|Iyengar|Mukherjee|Banerjee|Chatterjee|Das|Ghosh|Roy|Sinha|Thakur|Yadav|Tiwari|Dubey|Agarwal|Joshi|Kulkarni|Patil|Kaur|Gill|Bhatia|Fernandes|D'Souza|George|Thomas|Krishnan|Naidu|Choudhury)\b",
    "email": r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b",
    "url": r"(?i)https?://\S+|www\.\S+",
    "institution": r"(?i)\b[A-Z][a-z]{2,}\s+(?:Hospital|Clinic|Institute|Centre|Center|University|Diagnostics?|Imaging)\b",
    "date_text": r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b",
    "date_named": _MONTHS,
    "timestamp_ist": r"(?i)\b\d{1,2}:\d{2}(?::\d{2})?\s*(?:IST|UTC|GMT)\b",
    "mrn_like": r"\b[A-Z]{2,4}\d{6,12}\b",
}
# extension: personal data and secrets as they occur in web text
EXTENDED = {
    "ipv4": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "phone_paren": r"\+\d{1,2} \(\d{3}\) \d{3}-\d{4}",
    "card_16": r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b",
    "hex_token": r"\b[0-9a-f]{20,}\b",
}
# fixed values: patterns of the scrubber, applied in this order
SCRUB = {
    "aadhaar": SCAN["aadhaar"],
    "pan": SCAN["pan"],
    "voter_id": SCAN["voter_id"],
    "driving_license": SCAN["driving_license"],
    "passport": SCAN["passport"],
    "uhid": SCAN["uhid"],
    "indian_name": _TITLED,
    "indian_surname": r"(?i)\b(?:Kumar|Singh|Sharma|Verma|Gupta|Patel|Shah|Jain|Mishra|Pandey|Reddy|Rao|Nair|Menon|Pillai|Iyer|Iyengar|Mukherjee|Banerjee|Chatterjee|Bose|Sen|Das|Dey|Ghosh|Roy|Sinha|Thakur|Chauhan|Yadav|Tiwari|Dubey|Tripathi|Dwivedi|Shukla|Saxena|Agarwal|Joshi|Kulkarni|Deshmukh|Patil|Jadhav|Pawar|Shinde|More|Kaur|Gill|Dhillon|Bajwa|Sidhu|Randhawa|Bhatia|Sethi|Fernandes|D'Souza|Lobo|Sequeira|Pereira|George|Thomas|Rajan|Krishnan|Subramaniam|Venkatesh|Naidu|Choudhury)\b",
    "phone_india": SCAN["phone_india"],
    "phone_landline": SCAN["phone_landline"],
    "email": SCAN["email"],
    "url": SCAN["url"],
    "phone_intl": SCAN["phone_us"],
    "timestamp_ist": r"(?i)\b\d{1,2}:\d{2}(:\d{2})?\s*(IST|UTC|GMT|AM|PM)\b",
    "datetime_iso": r"\b\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2})?\b",
    "date_slash": r"\b\d{2}/\d{2}/\d{4}\b",
    "date_dash": r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b",
    "date_named": _MONTHS,
    "physician": r"\b(?:Dr\.?|Prof\.?)\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3}\b",
    "institution": r"(?i)\b[A-Z][a-z]+\s+(?:Hospital|Clinic|Medical|Institute|Centre|Center|Labs?|Diagnostics?|Imaging)\b",
    "accession": SCAN["mrn_like"],
}
# characters without which a pattern cannot match: a text without them is not tried against it
_NEEDS_DIGIT = {p for n, p in (SCAN | EXTENDED | SCRUB).items() if n not in ("name_indian", "surname_indian", "email", "url", "institution", "hex_token", "indian_name", "indian_surname", "physician")}
_NEEDS_AT = {SCAN["email"]}
_OWN = {*SCAN.values(), *EXTENDED.values(), *SCRUB.values()}
# fixed values: categories of identifiers with their tags
CATEGORIES = {
    "1. Names": ["PatientName", "OtherPatientNames", "PatientBirthName", "PatientMotherBirthName", "ReferringPhysicianName", "PerformingPhysicianName", "NameOfPhysiciansReadingStudy", "OperatorsName", "PhysiciansOfRecord", "ResponsiblePerson"],
    "2. Geographic data": ["PatientAddress", "InstitutionAddress", "InstitutionName", "InstitutionalDepartmentName", "StationName", "DistributionAddress", "DistributionName", "OrderEntererLocation", "Country"],
    "3. Dates": ["PatientBirthDate", "StudyDate", "SeriesDate", "AcquisitionDate", "ContentDate", "InstanceCreationDate", "PatientAge"],
    "4. Phone numbers": ["PatientTelephoneNumbers", "OrderCallbackPhoneNumber", "OrderCallbackTelecomInformation"],
    "5. Fax numbers": [],
    "6. Email addresses": ["PatientComments"],
    "7. Social Security numbers": ["PatientID", "OtherPatientIDs"],
    "8. Medical record numbers": ["PatientID", "OtherPatientIDs", "MedicalRecordLocator", "AccessionNumber"],
    "9. Health plan beneficiary numbers": ["PatientInsurancePlanCodeSequence"],
    "10. Account numbers": ["StudyID"],
    "11. Certificate/license numbers": [],
    "12. Vehicle identifiers": [],
    "13. Device identifiers": ["DeviceSerialNumber"],
    "14. Web URLs": ["RetrieveURL"],
    "15. IP addresses": [],
    "16. Biometric identifiers": [],
    "17. Full face photos": ["ReferencedPatientPhotoSequence"],
    "18. Any other unique identifying number/code": ["StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "FrameOfReferenceUID", "MediaStorageSOPInstanceUID", "ClinicalTrialSponsorName", "ClinicalTrialProtocolID", "ClinicalTrialSubjectID", "ClinicalTrialSiteID", "ClinicalTrialSiteName"],
}
# fixed values: categories that decide the risk
SENSITIVE = ["1. Names", "2. Geographic data", "4. Phone numbers", "6. Email addresses", "7. Social Security numbers"]
# fixed values: tags that a series should have
REQUIRED = ["PatientID", "PatientName", "PatientSex", "PatientBirthDate", "StudyDate", "StudyTime", "StudyDescription", "StudyInstanceUID", "SeriesNumber", "SeriesDescription", "SeriesInstanceUID", "Modality", "Manufacturer", "MagneticFieldStrength", "RepetitionTime", "EchoTime", "FlipAngle", "SliceThickness", "SpacingBetweenSlices", "PixelSpacing", "Rows", "Columns", "BitsAllocated", "ImageOrientationPatient", "ImagePositionPatient", "PhotometricInterpretation"]
# fixed values: tags that the sweep leaves alone
SAFE = ["Rows", "Columns", "BitsAllocated", "BitsStored", "HighBit", "PixelRepresentation", "SamplesPerPixel", "PhotometricInterpretation", "SmallestImagePixelValue", "LargestImagePixelValue", "NumberOfFrames", "ImageOrientationPatient", "ImagePositionPatient", "PixelSpacing", "SliceThickness", "SpacingBetweenSlices", "SliceLocation", "WindowCenter", "WindowWidth", "RescaleIntercept", "RescaleSlope", "Modality", "BodyPartExamined", "ScanningSequence", "SequenceVariant", "ScanOptions", "MRAcquisitionType", "ImageType", "RepetitionTime", "EchoTime", "InversionTime", "FlipAngle", "MagneticFieldStrength", "NumberOfAverages", "EchoTrainLength", "PixelBandwidth", "DeviceSerialNumber", "TransferSyntaxUID", "SOPClassUID", "MediaStorageSOPClassUID", "ImplementationClassUID", "ImplementationVersionName", "Manufacturer", "ManufacturerModelName", "SoftwareVersions", "SequenceName", "PixelData"]
# fixed values: tags that a scan passes over, as their values look like identifiers without being any
SKIPPED = ["PixelData", "OverlayData", "WaveformData", "SpectroscopyData", "EncapsulatedDocument", "Manufacturer", "ManufacturerModelName", "SoftwareVersions", "ImplementationClassUID", "ImplementationVersionName", "TransferSyntaxUID", "SOPClassUID", "MediaStorageSOPClassUID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "FrameOfReferenceUID", "MediaStorageSOPInstanceUID", "ReferencedSOPInstanceUID", "RelatedFrameOfReferenceUID", "SequenceName", "ScanningSequence", "SequenceVariant", "ImageType", "ScanOptions", "MRAcquisitionType", "BodyPartExamined", "Modality", "PhotometricInterpretation", "ImageOrientationPatient", "ImagePositionPatient", "PixelSpacing", "SliceLocation", "SliceThickness", "SpacingBetweenSlices", "WindowCenter", "WindowWidth", "RescaleIntercept", "RescaleSlope", "Rows", "Columns", "BitsAllocated", "BitsStored", "HighBit", "SmallestImagePixelValue", "LargestImagePixelValue", "NumberOfFrames", "SamplesPerPixel"]
# fixed values: tags by what the whole profile does with them
PROFILE = {
    "remove": ["PatientAddress", "PatientTelephoneNumbers", "PatientInsurancePlanCodeSequence", "MilitaryRank", "BranchOfService", "PatientReligiousPreference", "MedicalRecordLocator", "ReferencedPatientPhotoSequence", "ResponsiblePerson", "ResponsibleOrganization", "ClinicalTrialSponsorName", "ClinicalTrialProtocolID", "ClinicalTrialSubjectID", "ClinicalTrialSiteID", "ClinicalTrialSiteName", "RequestingPhysician", "ScheduledPerformingPhysicianName", "RequestAttributesSequence", "ContentSequence", "DistributionAddress", "DistributionName", "FillerOrderNumberImagingServiceRequest", "PlacerOrderNumberImagingServiceRequest", "OrderCallbackPhoneNumber", "OrderCallbackTelecomInformation", "OrderEnteredBy", "OrderEntererLocation", "IssuerOfPatientID", "IssuerOfPatientIDQualifiersSequence", "PatientBirthTime", "PatientAge", "EthnicGroup", "Occupation", "SmokingStatus", "PregnancyStatus", "PatientSexNeutered", "ConfidentialityConstraintOnPatientDataDescription", "ReferencedStudySequence", "ReferencedPerformedProcedureStepSequence", "SourceImageSequence", "ReferencedImageSequence", "OriginalAttributesSequence", "ImageComments", "StudyComments", "InterpretationAuthor", "InterpretationText", "ResultsComments", "PatientWeight", "PatientSize", "MedicalAlerts", "Allergies", "AdditionalPatientHistory", "PatientState", "PatientTransportArrangements", "CountryOfResidence", "RegionOfResidence", "CurrentPatientLocation", "PatientInstitutionResidence", "VisitComments", "DischargeDate", "DischargeDiagnosisDescription", "ServiceEpisodeDescription", "ServiceEpisodeID", "VerifyingObserverSequence", "AuthorObserverSequence", "ParticipantSequence", "CustodialOrganizationSequence", "ReasonForStudy", "RequestedProcedureCodeSequence", "ReferencedPatientSequence"],
    "blank": ["PatientName", "PatientID", "OtherPatientIDs", "OtherPatientNames", "PatientBirthName", "PatientMotherBirthName", "PatientComments", "AdditionalPatientHistory", "InstitutionName", "InstitutionAddress", "InstitutionalDepartmentName", "StationName", "ReferringPhysicianName", "PerformingPhysicianName", "NameOfPhysiciansReadingStudy", "OperatorsName", "PhysiciansOfRecord", "AdmittingDiagnosesDescription", "AdmittingDiagnosesCodeSequence", "AccessionNumber", "StudyID", "DeviceSerialNumber", "InstitutionalDepartmentTypeCodeSequence", "RequestedProcedureDescription", "PerformedProcedureStepDescription", "PerformedProcedureStepID", "RequestedProcedureID", "ScheduledProcedureStepDescription"],
    "uids": ["StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "FrameOfReferenceUID", "MediaStorageSOPInstanceUID", "ReferencedSOPInstanceUID", "RelatedFrameOfReferenceUID"],
    "dates": ["PatientBirthDate", "StudyDate", "SeriesDate", "AcquisitionDate", "ContentDate", "InstanceCreationDate", "PerformedProcedureStepStartDate"],
    "datetimes": ["AcquisitionDateTime"],
    "free": ["StudyDescription", "SeriesDescription", "ProtocolName", "PerformedProcedureStepDescription", "RequestedProcedureDescription", "ScheduledProcedureStepDescription", "InstitutionName", "InstitutionalDepartmentName"],
}
#: advice by what an inventory found
ADVICE = {
    "1. Names": "Names of patients or physicians occur: remove them before the data leave the institution.",
    "7. Social Security numbers": "Patient ids may derive from a national number: check their form and replace them.",
    "3. Dates": "Dates of birth or service occur: keep the year only, or shift all dates of a patient alike.",
    "2. Geographic data": "Institutions, addresses or stations occur: they tell the site and may have to go.",
    "18. Any other unique identifying number/code": "Instance ids occur and can be linked: hash them anew.",
    "13. Device identifiers": "Serial numbers of devices occur: an inventory of scanners could tell the site.",
}
HIGH_RISK = "%d files hold three or more sensitive categories: keep them inside until they are cleaned."
LITTLE_FOUND = "Little was found: fit for research after a light clean-up."
UID_ROOT = "1.2.826.0.1.3680043.10."


def scan(df: DataFrame, key: str, text: str, patterns: dict[str, str] = SCAN, least: int = 3) -> DataFrame:
    """key, pattern, match: every match of every pattern in texts of at least `least` characters."""
    rows = df.where(F.length(text) >= least).select(key, F.explode(matches(F.col(text), patterns)).alias("m"))
    return rows.select(key, "m.pattern", "m.match")


def matches(text: Column, patterns: dict[str, str] = SCAN) -> Column:
    """All matches as an array of (pattern, match). Patterns that need the same characters share one test for them."""
    one = lambda name, p: F.transform(F.regexp_extract_all(text, F.lit(java(p)), F.lit(0)), _named(name))
    none = F.array().cast("array<struct<pattern:string,match:string>>")
    return F.concat(none, *[_guarded(text, need, F.concat(none, *[one(n, p) for n, p in of]), none) for need, of in _by_need(patterns, joined=True)])


def match_count(text: Column, patterns: dict[str, str] = SCAN) -> Column:
    """How many matches all patterns have, each by itself."""
    one = lambda p: F.size(F.regexp_extract_all(text, F.lit(java(p)), F.lit(0)))
    return sum((_guarded(text, need, sum((one(p) for _, p in of), F.lit(0)), F.lit(0)) for need, of in _by_need(patterns, joined=True)), F.lit(0))


def _need(pattern: str) -> str | None:
    return "[0-9]" if pattern in _NEEDS_DIGIT else "@" if pattern in _NEEDS_AT else None


def _by_need(patterns: dict[str, str], joined: bool) -> list[tuple[str | None, list[tuple[str, str]]]]:
    """Patterns in runs of the same need, in their order; joined: one run for each need, whatever the order."""
    need = lambda item: _need(item[1])
    items = sorted(patterns.items(), key=lambda i: need(i) or "") if joined else patterns.items()
    return [(n, list(of)) for n, of in itertools.groupby(items, need)]


def _holds(text: Column, need: str) -> Column:
    return text.contains(need) if need == "@" else text.rlike(need)


def _guarded(text: Column, need: str | None, value: Column, other: Column) -> Column:
    return value if need is None else F.when(_holds(text, need), value).otherwise(other)


def quick(pattern: str) -> str:
    """An equal pattern: a list of whole words becomes a trie of them, so that a letter rules out all words without it."""
    listed = re.fullmatch(r"(\(\?i\))?\\b\(\?:([A-Za-z'|]+)\)\\b", pattern)
    if not listed:
        return pattern
    words = set(listed[2].lower().split("|") if listed[1] else listed[2].split("|"))
    if any(w.endswith("'") or w.startswith("'") for w in words) or any(v.startswith(w + "'") for v in words for w in words):
        return pattern  # a word could end inside another one
    return f"{listed[1] or ''}\\b{_trie(words)}\\b"


_ENDS = r"(?:(?<!\w)(?=\w)|(?<=\w)(?!\w))"


def java(pattern: str) -> str:
    """The quick pattern for Spark, where a word ends as in SQL: at anything but an ASCII letter, digit or underscore.

    Java's own \\b counts the letters of all scripts, but its \\w does not, so the ends are told by look-arounds: one where a
    character of a word follows or stands before, as at the ends of our own patterns and of lists of words.
    """
    out = quick(pattern)
    if pattern in _OWN or out != pattern:
        if m := re.match(r"(\(\?i\))?\\b(?!\[a-zA-Z0-9\.)", out):
            out = (m[1] or "") + r"(?<!\w)" + out[m.end() :]
        if out.endswith(r"\b"):
            out = out[:-2] + r"(?!\w)"
    return re.sub(r"\\.", lambda m: _ENDS if m[0] == r"\b" else m[0], out)


def _trie(words: set[str]) -> str:
    """The words by their first letters; the rest of each branch likewise."""
    if len(words) == 1:
        return next(iter(words))
    first = itertools.groupby(sorted(words - {""}), lambda w: w[0])
    whole = "(?:" + "|".join(c + _trie({w[1:] for w in of}) for c, of in first) + ")"
    return whole + "?" if "" in words else whole


def _named(name: str):
    return lambda m: F.struct(F.lit(name).alias("pattern"), m.alias("match"))


def scan_report(df: DataFrame, key: str, text: str, patterns: dict[str, str] = SCAN) -> DataFrame:
    """pattern, matches, files with it; one row per pattern that occurs."""
    return scan(df, key, text, patterns).groupBy("pattern").agg(F.count("*").alias("matches"), F.count_distinct(key).alias("files"))


def scan_tags(df: DataFrame, key: str, tags: str, patterns: dict[str, str] = SCAN, skipped: list[str] = SKIPPED, least: int = 3) -> DataFrame:
    """key, tag, pattern, match: every match in the values of a tag map, but for the skipped tags."""
    rows = df.select(key, F.explode(tags).alias("tag", "_value")).where(~F.col("tag").isin(skipped))
    return scan(rows.select(F.struct(key, "tag").alias("_at"), "_value"), "_at", "_value", patterns, least).select(f"_at.{key}", "_at.tag", "pattern", "match")


def scan_totals(df: DataFrame, key: str, tags: str, error: str, patterns: dict[str, str] = SCAN, skipped: list[str] = SKIPPED) -> DataFrame:
    """One row: files without and with matches, files that could not be read (`error` is set), matches, and whether all are clean.

    df has one row per file, so the keys differ.
    """
    found = scan_tags(df.where(F.col(error).isNull()), key, tags, patterns, skipped).groupBy(key).agg(F.count("*").alias("_n"))
    failed, n = F.col(error).isNotNull(), F.coalesce("_n", F.lit(0))
    out = df.select(key, error).join(found, key, "left").agg(F.count("*").alias("total_files"), F.count_if(~failed & (n == 0)).alias("clean_files"), F.count_if(n > 0).alias("dirty_files"), F.count_if(failed).alias("failed_files"), F.coalesce(F.sum(n), F.lit(0)).alias("total_matches"))
    return out.withColumn("passed", (F.col("dirty_files") == 0) & (F.col("failed_files") == 0))


def scrub(text: Column, patterns: dict[str, str] = SCRUB) -> Column:
    """Matches of the patterns deleted one pattern after another, spaces collapsed, ends trimmed."""
    return _collapsed(_deleted(text, patterns))


def _deleted(text: Column, patterns: dict[str, str]) -> Column:
    """A deletion adds no characters, so what the text lacks at first, it lacks before every pattern."""
    out = text
    for need, of in _by_need(patterns, joined=False):
        out = _without(out, need, [java(p) for _, p in of])
    return out


def _without(text: Column, need: str | None, patterns: list[str]) -> Column:
    run = lambda t: functools.reduce(lambda left, p: F.regexp_replace(left, p, ""), patterns, t)
    return run(text) if need is None else F.element_at(F.transform(F.array(text), lambda t: _guarded(t, need, run(t), t)), 1)


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s{2,}", " "))


def scrub_with_names(df: DataFrame, text: str, patterns: dict[str, str] = SCRUB) -> DataFrame:
    """df with `scrubbed` and `scrubbed_by`, the names of the patterns that changed the text."""
    names, cols = [], df.columns
    needs = {n: f"_holds{i}" for i, n in enumerate(sorted({_need(p) for p in patterns.values()} - {None}))}
    out = df.withColumns({"_t": F.col(text), **{at: _holds(F.col(text), n) for n, at in needs.items()}})
    for name, p in patterns.items():
        left, need = F.regexp_replace("_t", java(p), ""), _need(p)
        out = out.withColumn("_next", F.when(F.col(needs[need]), left).otherwise(F.col("_t")) if need else left)
        out = out.withColumns({f"_by_{name}": F.when(F.col("_next") != F.col("_t"), name), "_t": F.col("_next")})
        names.append(F.col(f"_by_{name}"))
    return out.select(*cols, F.trim(F.regexp_replace("_t", r"\s{2,}", " ")).alias("scrubbed"), F.array_compact(F.array(*names)).alias("scrubbed_by"))


def pseudonym(uid: Column, salt: str) -> Column:
    """A numeric id from the first 96 bits of a salted sha-256, under a fixed root, at most 64 characters."""
    h = F.sha2(F.concat(F.lit(salt), uid.cast("string")), 256)
    half = lambda at: F.conv(F.substring(h, at, 12), 16, 10).cast("decimal(38,0)")
    number = (half(1) * F.lit(1 << 48).cast("decimal(20,0)") + half(13)).cast("decimal(38,0)")
    return F.substring(F.concat(F.lit(UID_ROOT), number.cast("string")), 1, 64)


def shift_days(patient: Column, low: int = -365, high: int = -30) -> Column:
    """Days of the patient's shift, from a sha-256 of the id."""
    return (F.lit(low) + F.pmod(F.conv(F.substring(F.sha2(patient.cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(high - low + 1))).cast("int")


def shift_date(day: Column, days: Column) -> Column:
    """A shifted YYYYMMDD with whatever follows it; shorter strings stay, impossible dates become empty."""
    s = F.trim(day)
    moved = F.date_format(F.date_add(F.try_to_timestamp(F.substring(s, 1, 8), F.lit("yyyyMMdd")).cast("date"), days), "yyyyMMdd")
    return F.when(F.length(s) < 8, s).otherwise(F.coalesce(F.concat(moved, F.substring(s, 9, 1000)), F.lit("")))


def present(value: Column) -> Column:
    return value.isNotNull() & ~F.trim(value).isin("", "None", "0")


def inventory(df: DataFrame, key: str, tags: str, cleared: list[str] | None = None) -> DataFrame:
    """key, category, tag, found: a row per identifying tag that the map holds; cleared tags count as not found."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(t).alias("tag")) for c, ts in CATEGORIES.items() for t in ts])
    rows = df.select(key, F.col(tags).alias("_t"), F.explode(pairs).alias("p")).where(F.map_contains_key("_t", F.col("p.tag")))
    value = F.element_at("_t", F.col("p.tag"))
    return rows.where(value.isNotNull()).select(key, "p.category", "p.tag", (present(value) & ~F.col("p.tag").isin(cleared or [""])).alias("found"))


def risk(categories: Column) -> Column:
    n = F.size(F.array_intersect(categories, F.array(*map(F.lit, SENSITIVE))))
    return F.when(n >= 3, "high").when(n >= 1, "medium").when(F.size(categories) > 0, "low").otherwise("none")


def file_risk(found: DataFrame, key: str) -> DataFrame:
    """key, n_found, n_empty, categories, risk."""
    out = found.groupBy(key).agg(F.count_if("found").alias("n_found"), F.count_if(~F.col("found")).alias("n_empty"), F.sort_array(F.collect_set(F.when(F.col("found"), F.col("category")))).alias("categories"))
    return out.withColumn("risk", risk(F.col("categories")))


def compliance(found: DataFrame, key: str) -> DataFrame:
    """One row: files by risk, categories with data, and the score max(0, 100 - 50 * found / looked at - 50 * categories / 18)."""
    files = file_risk(found, key)
    risks = files.agg(*[F.count_if(F.col("risk") == r).alias(f"n_{r}") for r in ("high", "medium", "low", "none")])
    all_found = found.agg(F.count_if("found").alias("n_found"), F.count("*").alias("n_checked"), F.count_distinct(F.when(F.col("found"), F.col("category"))).alias("n_categories"))
    score = F.greatest(F.lit(0.0), 100 - 50 * F.coalesce(F.col("n_found") / F.col("n_checked"), F.lit(0.0)) - 50 * F.col("n_categories") / len(CATEGORIES))
    return all_found.join(F.broadcast(risks)).withColumn("score", score)


def recommendations(found: DataFrame, key: str, least: float = 90) -> DataFrame:
    """place, advice: what an inventory calls for, in a fixed order."""
    there = found.agg(F.collect_set(F.when(F.col("found"), F.col("category"))).alias("_there"))  # at most 18 names
    one = compliance(found, key).join(F.broadcast(there))
    told = [F.when(F.array_contains("_there", c), F.lit(text)) for c, text in ADVICE.items()]
    told += [F.when(F.col("n_high") > 0, F.format_string(HIGH_RISK, F.col("n_high"))), F.when(F.col("score") >= least, F.lit(LITTLE_FOUND))]
    return one.select(F.posexplode(F.array_compact(F.array(*told))).alias("place", "advice"))


def may_publish(report: DataFrame, least: float = 90) -> DataFrame:
    """Refused if the score is low and some file is of high risk."""
    return report.withColumn("publish", ~((F.col("score") < least) & (F.col("n_high") > 0)))


def conformance(df: DataFrame, key: str, tags: str, required: list[str] = REQUIRED) -> DataFrame:
    """key, missing_tags, missing_count, completeness_pct; only rows that miss some."""
    value = lambda t: F.try_element_at(F.col(tags), t)
    missing = F.filter(F.array(*map(F.lit, required)), lambda t: value(t).isNull() | value(t).isin("", "None"))
    out = df.select(key, missing.alias("missing_tags")).withColumn("missing_count", F.size("missing_tags"))
    return out.where("missing_count > 0").withColumn("completeness_pct", (len(required) - F.col("missing_count")) * 100.0 / len(required))


def private_tags(df: DataFrame, key: str, tags: str, most: int = 10) -> DataFrame:
    """key, n, first tags: tags `(gggg,eeee)` of an odd group; at most `most` are listed, all are counted."""
    odd = F.array_sort(F.filter(F.map_keys(tags), lambda t: F.conv(F.substring(t, 2, 4), 16, 10).cast("long") % 2 == 1))
    return df.select(key, odd.alias("_odd")).where(F.size("_odd") > 0).select(key, F.size("_odd").alias("n"), F.slice("_odd", 1, most).alias("first"))


def deidentified(df: DataFrame, tags: str, patient: Column, salt: str, remove: list[str], blank: list[str], uids: list[str], dates: list[str], free: list[str], patterns: dict[str, str] = SCRUB) -> DataFrame:
    """df with the tag map cleaned: private and listed tags removed, others blanked, pseudonymised, shifted or scrubbed; then all are swept, but for the pseudonyms."""
    days = shift_days(patient)
    kept = F.map_filter(F.col(tags), lambda k, v: ~k.isin(remove or [""]) & ~_private(k))
    cleaned = F.transform_values(kept, lambda k, v: F.when(k.isin(blank or [""]), "").when(k.isin(uids or [""]), pseudonym(v, salt)).when(k.isin(dates or [""]), shift_date(v, days)).when(k.isin(free or [""]), scrubbed_where_found(v, patterns)).otherwise(v))
    return df.withColumn(tags, swept(cleaned, patterns, safe=[*SAFE, *uids]))


def _private(tag: Column) -> Column:
    return tag.startswith("(") & (F.conv(F.substring(tag, 2, 4), 16, 10).cast("long") % 2 == 1)


def scrubbed_where_found(value: Column, patterns: dict[str, str] = SCRUB) -> Column:
    """The scrubbed value if a pattern matches, else the value as it is, with all its spaces."""
    return F.element_at(F.transform(F.array(_deleted(value, patterns)), lambda left: F.when(left != value, _collapsed(left)).otherwise(value)), 1)


def swept(tags: Column, patterns: dict[str, str] = SCRUB, least: int = 4, safe: list[str] = SAFE) -> Column:
    """The tag map with every value of at least `least` characters scrubbed, but for safe tags and pixels; values without a match stay as they are."""
    looked_at = lambda k, v: (F.length(v) >= least) & ~k.isin(safe or [""]) & ~F.lower(k).startswith("(7fe0")
    return F.transform_values(tags, lambda k, v: F.when(looked_at(k, v), scrubbed_where_found(v, patterns)).otherwise(v))


def verified_clean(tags: Column, remove: list[str], blank: list[str]) -> Column:
    """True if no tag to be removed or blanked has a value and no private tag is left."""
    left = F.map_filter(tags, lambda k, v: _private(k) | (k.isin([*remove, *blank] or [""]) & (F.trim(F.coalesce(v, F.lit(""))) != "")))
    return F.size(left) == 0


def constraint_failures(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, rule: every rule that a row breaks, all at once. A rule that is null holds."""
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(key, F.explode(broken).alias("rule"))
