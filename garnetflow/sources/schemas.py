"""Schemas of everything that is read. Nothing is inferred: unknown fields are ignored, missing ones are null."""

from __future__ import annotations

NVD_FEED = "vulnerabilities array<struct<cve: struct<id: string, published: string, lastModified: string, descriptions: array<struct<lang: string, value: string>>, weaknesses: array<struct<description: array<struct<lang: string, value: string>>>>, metrics: struct<cvssMetricV31: array<struct<cvssData: struct<version: string, vectorString: string, baseScore: double, baseSeverity: string>>>, cvssMetricV30: array<struct<cvssData: struct<version: string, vectorString: string, baseScore: double, baseSeverity: string>>>, cvssMetricV2: array<struct<cvssData: struct<version: string, vectorString: string, baseScore: double, baseSeverity: string>>>>, references: array<struct<url: string, source: string, tags: array<string>>>>>>"
NVD_FEED_V11 = "CVE_Items array<struct<cve: struct<CVE_data_meta: struct<ID: string>, problemtype: struct<problemtype_data: array<struct<description: array<struct<lang: string, value: string>>>>>, description: struct<description_data: array<struct<lang: string, value: string>>>>, publishedDate: string, impact: struct<baseMetricV3: struct<cvssV3: struct<version: string, vectorString: string, baseScore: double, baseSeverity: string>>>>>"
TRAINING = "cve_id string, description string, cwes array<string>, attack_vectors array<string>, published_date string"
EPSS = "data array<struct<cve: string, epss: string, percentile: string, date: string, `time-series`: array<struct<epss: string, percentile: string, date: string>>>>"
STIX = "objects array<struct<type: string, id: string, name: string, description: string, external_references: array<struct<source_name: string, external_id: string, url: string, description: string>>, kill_chain_phases: array<struct<kill_chain_name: string, phase_name: string>>, x_mitre_platforms: array<string>, x_mitre_tactics: array<string>, x_mitre_data_sources: array<string>, x_mitre_shortname: string, aliases: array<string>, source_ref: string, target_ref: string, relationship_type: string, x_mitre_version: string>>"
CWE_XML = "_ID string, _Name string, _Abstraction string, Description string, Extended_Description string, Related_Weaknesses struct<Related_Weakness: array<struct<_Nature: string, _CWE_ID: string, _View_ID: string>>>, Related_Attack_Patterns struct<Related_Attack_Pattern: array<struct<_CAPEC_ID: string>>>"
CAPEC_XML = (
    "_ID string, _Name string, Description string, Likelihood_Of_Attack string, Typical_Severity string, Related_Attack_Patterns struct<Related_Attack_Pattern: array<struct<_Nature: string, _CAPEC_ID: string>>>, "
    "Execution_Flow struct<Attack_Step: array<struct<Step: string, Phase: string, Description: string, Technique: array<string>>>>, Prerequisites struct<Prerequisite: array<string>>, "
    "Skills_Required struct<Skill: array<struct<_Level: string, _VALUE: string>>>, Consequences struct<Consequence: array<struct<Scope: array<string>, Impact: array<string>>>>, "
    "Related_Weaknesses struct<Related_Weakness: array<struct<_CWE_ID: string>>>, Taxonomy_Mappings struct<Taxonomy_Mapping: array<struct<_Taxonomy_Name: string, Entry_ID: string, Entry_Name: string>>>"
)
CWE_NODE = "struct<id: string, name: string, abstraction: string, parents: array<string>, children: array<string>, attack_vectors: array<string>>"
CAPEC_NODE = "struct<name: string, description: string, likelihoodOfAttack: string, typicalSeverity: string, prerequisites: array<string>, relatedWeaknesses: array<string>, mitreAttack: array<string>>"
TECHNIQUE_NODE = "struct<name: string, description: string, tactics: array<string>, platforms: array<string>, dataSources: array<string>, mitigations: array<string>, relatedTechniques: array<string>, groups: array<string>, software: array<string>, url: string>"
ATOMIC = "technique string, name string, description string, platforms array<string>, executor string, command string"
EMBEDDINGS = "id string, type string, text string, embedding array<double>, metadata struct<name: string, published: string, cvss: double, severity: string, likelihood: string>"
