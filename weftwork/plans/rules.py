"""Dossier rules: what a document of one type collects."""

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Related:
    """One dossier field taken from rows of another element type that carry the key."""

    field: str
    type_id: str
    key: str
    value: str


@dataclass(frozen=True)
class Extension:
    """Two hops: the first gives values, the second what elements with those values hold."""

    first: Related
    second: tuple[Related, ...] = ()


@dataclass(frozen=True)
class DossierRule:
    doc_type: str
    model: str
    root_type: str
    key: str
    root_fields: tuple[tuple[str, str], ...] = ()  # (property, dossier field)
    entity_fields: tuple[Related, ...] = ()
    relation_fields: tuple[Related, ...] = ()
    extensions: tuple[Extension, ...] = ()
    collection: str | None = None
    skipped: tuple[str, ...] = field(default=(), compare=False)  # fields whose mapping is incomplete


def rule_from_json(text: str) -> DossierRule:
    """Sort the mappings of a rule document into root, entity, relation and two-hop fields.

    A mapping that lacks what it needs is skipped and listed in ``skipped``.
    """
    document = json.loads(text)
    root, entity, relation, extensions, skipped = [], [], [], [], []
    mappings = (document.get("propertyMappings") or []) + (document.get("indexPropertyMappings") or [])
    for mapping in mappings:
        target = mapping.get("dPropertyName")
        sources = mapping.get("sourceTargetEntities") or [{}]
        source = sources[0]
        if mapping.get("needExtendsion"):
            hop = _related(source, source.get("dPropertyName"), "linkedRelationType")
            second = [_related(s, s.get("dPropertyName"), "targetEntityType") for s in source.get("secondLevel") or []]
            if source.get("onlyFromRel") and hop:
                extensions.append(Extension(hop, tuple(s for s in second if s)))
            else:
                skipped.append(source.get("dPropertyName") or "")
        elif not mapping.get("needRelation"):
            if mapping.get("sPropertyName"):
                root.append((mapping["sPropertyName"], target))
            else:
                skipped.append(target)
        else:
            from_relation = bool(source.get("onlyFromRel"))
            related = _related(source, target, "linkedRelationType" if from_relation else "targetEntityType")
            if related:
                (relation if from_relation else entity).append(related)
            else:
                skipped.append(target)
    return DossierRule(
        doc_type=document["docType"],
        model=document["elpModel"],
        root_type=document["elpType"],
        key=document["key"],
        root_fields=tuple(root),
        entity_fields=tuple(entity),
        relation_fields=tuple(relation),
        extensions=tuple(extensions),
        collection=document.get("docCollectionName"),
        skipped=tuple(skipped),
    )


def _related(source: dict, target: str | None, type_name: str) -> Related | None:
    parts = (target, source.get(type_name), source.get("sPropertyId"), source.get("sPropertyName"))
    return Related(*parts) if all(parts) else None


def load_rule(collection: DataFrame, doc_type: str) -> DossierRule:
    """The one rule of a document type; ``value`` holds the rule documents as JSON."""
    found = collection.filter(F.get_json_object("value", "$.docType") == doc_type).select("value").take(2)
    if len(found) != 1:
        raise ValueError(f"{doc_type} must have exactly one rule")
    return rule_from_json(found[0]["value"])
