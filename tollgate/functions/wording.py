"""Texts that reports and explanations print, kept together and unchanged."""

# Missing values and emoji marks.
NOT_AVAILABLE = "N/A"
BAND_MARKS = {"HIGH": "🔴", "MEDIUM": "🟡", "LOW": "🟢"}
LABEL_MARKS = {True: "✅ Yes", False: "❌ No"}
OPTION_FRAUD = "✅ Fraud"
OPTION_LEGITIMATE = "❌ Legit"

# Column titles of the display table.
DISPLAY_TITLES = {
    "txn_id_clean": "Transaction ID",
    "txn_date": "Date",
    "amount": "Amount",
    "txns_last_24h": "Txns (24h)",
    "merchant_risk_tier": "Merchant Risk",
    "is_fraud": "Fraud",
    "risk_score": "Risk Score",
    "risk_band": "Risk Band",
}

# Rule explanation. {} takes the formatted value.
RULE_VELOCITY = "High transaction velocity: {} transactions in the last 24 hours"
RULE_AMOUNT = "Unusual amount: {}x the card's average transaction amount"
RULE_MERCHANT = "Merchant is flagged as high-risk tier"
RULE_EMULATOR = "Transaction originated from an emulator device"
RULE_MERCHANT_RATE = "Merchant has elevated fraud rate: {}% in last 30 days"
RULE_DECLINES = "Multiple declined transactions: {} in the last 24 hours"
RULE_NONE = "No significant risk factors identified"

# One-line assessment.
ASSESS_HIGH_CONFIRMED = "🚨 **HIGH RISK FRAUDSTER** - Confirmed fraud with multiple high-risk indicators"
ASSESS_HIGH_FACTORS = "🚨 **HIGH RISK** - Strong fraud signals detected: {}"
ASSESS_HIGH = "🚨 **HIGH RISK** - Elevated fraud probability based on ensemble model"
ASSESS_MEDIUM_FACTORS = "⚠️ **MEDIUM RISK** - Review recommended due to: {}"
ASSESS_MEDIUM = "⚠️ **MEDIUM RISK** - Moderate fraud probability, manual review suggested"
ASSESS_LOW_CONFIRMED = "✅ **LOW RISK (False Negative)** - Legitimate-looking but confirmed fraud (model miss)"
ASSESS_LOW = "✅ **LOW RISK** - Transaction appears legitimate with minimal risk indicators"
FACTOR_VELOCITY = "high velocity"
FACTOR_SOME_VELOCITY = "moderate velocity"
FACTOR_DECLINES = "multiple declines"
FACTOR_MERCHANT = "high-risk merchant"
FACTOR_EMULATOR = "emulator device"
FACTOR_MERCHANT_RATE = "elevated merchant fraud rate"

# Model explanations: feature titles and contexts.
FEATURE_TITLES = {
    "txns_last_24h": "Transaction Velocity",
    "declined_txns_last_24h": "Decline History",
    "merchant_fraud_rate_30d": "Merchant Fraud Rate",
    "is_high_risk_merchant": "High-Risk Merchant Flag",
    "is_emulator_device": "Emulator Device",
}
VELOCITY_CONTEXT = (" (High velocity - typical fraud pattern)", " (Normal velocity)")
DECLINE_CONTEXT = (" (Card testing pattern detected)", " (Normal decline rate)")
MERCHANT_CONTEXT = (" (High-risk merchant)", " (Normal merchant risk)")
SHAP_NONE = "SHAP analysis: No significant feature contributions identified"
FOREST_TITLES = {
    "txns_last_24h": "Transaction velocity",
    "declined_txns_last_24h": "Decline history",
    "merchant_fraud_rate_30d": "Merchant fraud rate",
    "is_high_risk_merchant": "High-risk merchant flag",
    "is_emulator_device": "Emulator device",
}

# Model explanations: value texts. {} takes the formatted value.
VALUE_TEXTS = {
    "txns_last_24h": "{} transactions in last 24h",
    "declined_txns_last_24h": "{} declined transactions",
    "merchant_fraud_rate_30d": "{}% historical fraud rate",
    "is_high_risk_merchant": "Merchant risk tier: {}",
    "is_emulator_device": "Emulator detected: {}",
}
